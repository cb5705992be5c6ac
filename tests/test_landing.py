"""Frames as a stream: bytes cut anywhere, batches, restarts and bad headers."""

import random
import struct

import pytest

from tidemark.functions import codec as C
from tidemark.plans import events as E
from tidemark.sources import landing
from tidemark.sources.landing import FrameReader, connections

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frames(spark):
    """The frames of two scopes in order."""
    rows = E.frames(spark, SF).where("scope IN ('view', 'click')").orderBy("scope", "day", "sequence").select("scope", "frame").collect()
    return {s: [bytes(r["frame"]) for r in rows if r["scope"] == s] for s in ("view", "click")}


def land(folder, name, data, cuts, first=0):
    (folder / name).mkdir(parents=True, exist_ok=True)
    for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(data)], strict=True)):
        (folder / name / f"{first + k:06d}.bin").write_bytes(data[a:b])


def read_all(folder, reader=None, start=None):
    """Rows of all that has landed since start, batch by batch, as a stream would ask for them."""
    reader, rows, now = reader or FrameReader({"path": str(folder)}), [], start or {}
    while (end := reader.latestOffset()) != now:
        for p in reader.partitions(now, end):
            rows += [r for b in reader.read(p) for r in b.to_pylist()]
        now = end
    return rows, now


def test_bytes_cut_anywhere(frames, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "SPLIT", 9_000)  # several tasks a batch
    rng = random.Random(2)
    for name, own in frames.items():
        data = b"".join(own)
        land(tmp_path, name, data, sorted(rng.sample(range(1, len(data)), 60)))
        (tmp_path / name / "000001.bin").write_bytes((tmp_path / name / "000001.bin").read_bytes())
    (tmp_path / "view" / "000099.bin").write_bytes(b"")  # an empty file at the end
    for most in (1 << 30, 10_000):
        rows, _ = read_all(tmp_path, FrameReader({"path": str(tmp_path), "maxBytesPerTrigger": str(most)}))
        for name, own in frames.items():
            assert [r["frame"] for r in rows if r["connection"] == name] == own
        assert all(r["error"] is None and r["kind"] == "BATCH" for r in rows)


def test_what_is_not_whole_waits(frames, tmp_path):
    own = frames["view"]
    data = b"".join(own)
    half = len(own[0]) + len(own[1]) // 2
    land(tmp_path, "view", data[:half], [])
    reader = FrameReader({"path": str(tmp_path)})
    rows, at = read_all(tmp_path, reader)
    assert [r["frame"] for r in rows] == own[:1]
    land(tmp_path, "view", data[half : half + 10], [], 1)
    assert read_all(tmp_path, reader, at) == ([], at)
    land(tmp_path, "view", data[half + 10 :], [], 2)
    rows, _ = read_all(tmp_path, reader, at)
    assert [r["frame"] for r in rows] == own[1:]


def header(length, magic=b"TICK", size=16):
    return struct.pack("<4sHHII", magic, 1, 1, length, size)


@pytest.mark.parametrize(("head", "error"), [(header(19), "INVALID_FRAME"), (header(0), "INVALID_FRAME"), (header(1 << 21), "OVERSIZED_FRAME"), (header(100, b"TOCK"), "INVALID_FRAME"), (header(100, size=17), "INVALID_FRAME"), (header(1 << 21, b"TOCK"), "OVERSIZED_FRAME")])
def test_bad_headers_end_a_connection(frames, tmp_path, head, error):
    own = frames["view"][:2]
    land(tmp_path, "view", own[0] + head + own[1], [5])
    land(tmp_path, "click", b"".join(frames["click"]), [])
    reader = FrameReader({"path": str(tmp_path)})
    rows, at = read_all(tmp_path, reader)
    assert [(r["error"], r["frame"]) for r in rows if r["connection"] == "view"] == [(None, own[0]), (error, head)]
    assert [r["frame"] for r in rows if r["connection"] == "click"] == frames["click"]
    land(tmp_path, "view", own[0], [], 7)
    assert read_all(tmp_path, reader, at) == ([], at)


def test_a_spoiled_frame_is_a_row(frames, tmp_path):
    own = frames["view"][:3]
    spoiled = own[1][:-1] + bytes([own[1][-1] ^ 1])
    land(tmp_path, "view", own[0] + spoiled + own[2], [])
    rows, _ = read_all(tmp_path)
    assert [(r["error"], r["frame"]) for r in rows] == [(None, own[0]), ("CRC_MISMATCH", spoiled), (None, own[2])]


def test_new_readers_walk_from_the_hint(frames, tmp_path, monkeypatch):
    data = b"".join(frames["view"])
    land(tmp_path, "view", data, [1000, 3000])
    reader = FrameReader({"path": str(tmp_path)})
    _, at = read_all(tmp_path, reader)
    reader.commit(at)
    assert set(connections(str(tmp_path))) == {"view"}
    land(tmp_path, "view", frames["view"][0], [], 5)
    heads, real = [], landing.header_error
    monkeypatch.setattr(landing, "header_error", lambda h: heads.append(h) or real(h))
    rows, _ = read_all(tmp_path, None, at)
    assert [r["frame"] for r in rows] == frames["view"][:1] and len(heads) <= 4
    (tmp_path / "_read").write_bytes(b"broken")
    assert FrameReader({"path": str(tmp_path)}).latestOffset()["view"][0] == "000005.bin"


def test_a_stream_that_restarts_loses_and_repeats_nothing(spark, frames, tmp_path):
    landing.register(spark)
    rng = random.Random(3)
    source, out = tmp_path / "in", tmp_path / "out"
    data = {name: b"".join(own) for name, own in frames.items()}
    done = dict.fromkeys(data, 0)
    for run in range(3):
        for name, whole in data.items():
            to = len(whole) if run == 2 else rng.randrange(done[name], len(whole))
            land(source, name, whole[done[name] : to], [], run)
            done[name] = to
        stream = spark.readStream.format("frames").option("maxBytesPerTrigger", "20000").load(str(source))
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start(str(out))
        query.awaitTermination()
    rows = spark.read.parquet(str(out)).collect()
    for name, own in frames.items():
        mine = sorted((r["file"], r["byte"], bytes(r["frame"])) for r in rows if r["connection"] == name)
        assert sorted(f for _, _, f in mine) == sorted(own) and len(mine) == len(own)
    want = [C.decode_message(f)[0] for own in frames.values() for f in own]
    assert sorted(r["kind"] for r in rows) == sorted(want) and all(r["error"] is None for r in rows)

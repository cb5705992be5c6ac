"""Segments read in byte ranges: the same entries as of whole files, markers inside frames, and spoiled bytes."""

import random

import pytest

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.plans import events as E
from tidemark.sources import ranges, wal

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sealed(spark, tmp_path_factory):
    """Segments of several sizes; some frames hold the commit marker and what looks like an entry."""
    folder, rng = tmp_path_factory.mktemp("sealed"), random.Random(4)
    frames = [bytes(r["frame"]) for r in E.frames(spark, SF).orderBy("scope", "day", "sequence").limit(12).collect()]
    message = C.decode_message(frames[0])[1]
    writer = wal.Writer("gateway")
    for k, size in enumerate((1, 9, 40)):
        for n in range(size):
            frame = rng.choice(frames)
            if n % 5 == 2:  # the marker, and an entry's header after it, inside a string of the frame
                inside = C.u32(D.COMMIT) + b"....AAAA"
                frame = C.encode_message("BATCH", message | {"producer_session_id": inside.decode("latin-1").encode("ascii", "replace").decode() + "COMM" * 3 + "MMOC" * 3, "batch_sequence": 1000 * k + n})
            writer.append(frame, 100 + n, n)
        (folder / f"{k}.rtw").write_bytes(writer.seal())
    return folder


def plain(df):
    return sorted((r["object_key"], int(r["sequence"]), r["receive_wall_s"], int(r["receive_monotonic_us"]), bytes(r["previous_entry_hash"]), bytes(r["frame"]), bytes(r["batch_hash"]), bytes(r["entry_hash"]), bytes(r["object_sha256"])) for r in df.collect())


@pytest.mark.parametrize("split", [1_000, 7_777, 1 << 20])
def test_ranges_give_the_entries_of_whole_files(spark, sealed, split):
    want = plain(wal.entries(spark, str(sealed)))
    assert b"MMOC" in b"".join(r[5] for r in want) and len(want) == 50
    for path in (str(sealed), f"file://{sealed}"):
        assert plain(ranges.entries(spark, path, split)) == want
        if split > 1_000:
            break


def test_a_file_is_read_by_several_tasks(spark, sealed):
    assert ranges.entries(spark, str(sealed), 5_000).rdd.getNumPartitions() > 3
    (sealed / "none").mkdir()
    assert ranges.entries(spark, str(sealed / "none")).count() == 0


@pytest.mark.parametrize("place", ["header", "frame", "hash", "trailer", "cut"])
def test_spoiled_bytes_fail(spark, sealed, tmp_path, place):
    data = bytearray((sealed / "1.rtw").read_bytes())
    at = {"header": 5, "frame": 400, "hash": len(data) // 2, "trailer": len(data) - 60, "cut": 0}[place]
    if place == "cut":
        data = data[: len(data) // 2]
    else:
        data[at] ^= 1
    (tmp_path / "1.rtw").write_bytes(data)
    with pytest.raises(Exception, match="trailer|header|hash|checksum|entries|decode"):
        ranges.entries(spark, str(tmp_path), 3_000).collect()


def test_candidates_that_no_chain_reaches():
    import numpy as np

    position, successor = np.array([10, 15, 20, 33, 40]), np.array([20, 33, 40, 50, 60])
    assert ranges.reached(position, successor, 10).tolist() == [True, False, True, False, True]
    assert ranges.reached(position, successor, 11).tolist() == [False] * 5

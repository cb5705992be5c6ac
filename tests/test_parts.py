"""Parts, receipts and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import cli
from tidemark.functions import codec as C
from tidemark.operators import continuity
from tidemark.plans import events as E
from tidemark.sources import parts, wal

SF = "/root/testdata/sf0.001"


def test_parts_carry_the_stream(spark, tmp_path):
    frames = E.frames(spark, SF)
    built = parts.build(frames, E.SCOPE, E.IDENTITY, max_rows=30).cache()
    roots = {(r["scope"], r["day"]): r["last"] for r in built.groupBy("scope", "day").agg(F.max_by("last_row_chain_hash", "part_sequence").alias("last")).collect()}
    want = {(r["scope"], r["day"]): r["root"] for r in continuity.summary(continuity.replay(frames, E.SCOPE, E.IDENTITY)).collect()}
    assert roots == want and built.agg(F.max("row_count")).first()[0] <= 30
    assert parts.checked(built).count() == built.count()
    some = built.limit(3)
    assert parts.store(some, f"file://{tmp_path}") == 3 and parts.store(some, f"file://{tmp_path}") == 0
    row = built.first()
    bad = bytearray(bytes(row["content"]))
    bad[len(bad) // 2] ^= 1
    with pytest.raises(C.FormatError):
        parts.verify(bytes(bad), row["part_sha256"], 0, bytes(32))
    with pytest.raises(C.FormatError):
        parts.verify(bytes(row["content"]), row["part_sha256"], row["first_stream_sequence"] + 1, bytes.fromhex(row["previous_row_chain_hash"]))


def test_contracts():
    assert parts.claim({"publisher_id": "p"})[1] != parts.claim({"publisher_id": "q"})[1]
    with pytest.raises(C.FormatError):
        parts.receipt("0" * 64, "1" * 64, "k")
    assert json.loads(parts.receipt("1" * 64, "2" * 64, "k"))["verification_complete"] is True
    limits = {n: 100 for n in ("max_metadata_object_bytes", "max_total_metadata_bytes", "max_parquet_object_bytes", "max_total_parquet_bytes", "max_list_objects", "max_graph_nodes", "max_parts", "max_observation_bytes", "max_observation_requests", "max_publication_rounds")}
    assert len(parts.bundle({"part_manifests": [1]}, limits)[1]) == 64
    with pytest.raises(C.FormatError):
        parts.bundle({"part_manifests": [1] * 50}, limits)
    with pytest.raises(C.FormatError):
        parts.final_observation({"complete": False})


def test_command_line(spark, tmp_path, capsys):
    first = {r["path"].split("/")[0]: r for r in E.segments(spark, SF).collect()}  # one of each gateway
    for k, r in enumerate(list(first.values())[:2]):
        (tmp_path / f"{k}.rtw").write_bytes(bytes(r["content"]))
    assert cli.main(["verify-scope", str(tmp_path)], spark) == 0
    assert json.loads(capsys.readouterr().out)["segments"] == 2
    with pytest.raises(ValueError, match="unknown"):
        cli.Config.load('raw_manifests = "a"\nscopes = "b"\nnew = 1')
    day = tmp_path / "m"
    day.mkdir()
    data = C.canonical_json({"dataset_id": "demo", "date": "2024-03-09", "revision": 1, "objects": [{"key": "k", "sha256": "s", "bytes": 5, "start_ingest_sequence": 1, "end_ingest_sequence": 2, "first_record_ordinal": 0, "last_record_ordinal": 0}]})
    digest = C.sha(cli.D.RAW_DAY, data).hex()
    (day / f"raw-day-1-{digest}.json").write_bytes(data)
    (tmp_path / "scopes.json").write_text('{"scope_key": "s", "dataset_id": "demo", "provider_id": "v", "symbol": "x"}\n')
    (tmp_path / "c.toml").write_text(f'raw_manifests = "{day}"\nscopes = "{tmp_path}/scopes.json"\n')
    assert cli.main(["--config", f"{tmp_path}/c.toml", "datasets"], spark) == 0
    assert json.loads(capsys.readouterr().out) == {"items": [{"dataset_id": "demo"}]}
    assert cli.main(["--config", f"{tmp_path}/c.toml", "fetch-plan", "demo", digest], spark) == 0
    assert json.loads(capsys.readouterr().out)["items"][0]["bytes"] == 5
    assert cli.main(["--config", f"{tmp_path}/c.toml", "fetch-plan", "demo", "f" * 64], spark) == 2
    wal.register(spark)


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["before_checkpoint", "after_checkpoint", "after_trash", "after_delete"])
def test_prune_survives_a_crash_at_each_step(spark, tmp_path, step):
    from tidemark.operators import retention

    (tmp_path / "sealed").mkdir()
    actions = []
    for k in (1, 2):
        data = b"segment" * k
        (tmp_path / "sealed" / f"{k}.rtw").write_bytes(data)
        actions.append({"artifact_id": f"a{k}", "name": f"{k}.rtw", "start_sequence": k, "end_sequence": k, "retained_chain_root": "c" * 64, "segment_sha256": C.sha(data).hex()})

    def fault(at, artifact):
        if (at, artifact) == (step, "a2"):
            raise Crash

    root = f"file://{tmp_path}"
    with pytest.raises(Crash):
        retention.Executor(spark, root, fault).execute(actions)
    own = retention.Executor(spark, root)
    own.recover()
    assert own.execute(actions) == ["a1", "a2"] and not list((tmp_path / "sealed").glob("*.rtw")) and not list((tmp_path / "trash").glob("*.rtw"))
    assert [c["end_sequence"] for c in own.checkpoints()] == [1, 2]
    with pytest.raises(C.FormatError):
        own.execute([actions[0] | {"artifact_id": "x", "start_sequence": 9, "end_sequence": 9}])

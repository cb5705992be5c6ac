"""The queries on ingestion, evidence and checks against their SQL, and on empty events."""

import json

import pytest

import __spark_entry__
from tidemark import cli
from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.operators import publication
from tidemark.plans import checks_oracle, evidence_oracle, ingest_oracle
from tidemark.sources.store import FolderStore

SF = "/root/testdata/sf0.001"
ORACLE = ingest_oracle.ORACLE | evidence_oracle.ORACLE | checks_oracle.ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_sql(spark, compare, name):
    compare(__spark_entry__.queries()[name](spark, SF), ORACLE[name], SF)
    assert __spark_entry__.oracle_sql()[name] == ORACLE[name]


@pytest.mark.parametrize("name", ["lease_outcomes", "journal_divergence", "retention_proofs", "shared_budget", "bundle_faults", "incremental_days", "application_status"])
def test_empty_events(spark, tmp_path, name):
    spark.read.parquet(f"{SF}/events.parquet").limit(0).write.parquet(f"{tmp_path}/events.parquet")
    assert __spark_entry__.queries()[name](spark, str(tmp_path)).count() == 0


def test_fetching_by_kind(spark, tmp_path, capsys):
    """Raw and replay days are told apart by key, by digest or as asked; part files are checked on the way."""
    scope = {"dataset_id": "demo", "day_definition_id": "utc-day-v1", "date": "2024-03-09", "replay_contract_id": "replay-v1", "conversion_id": "conversion-v1", "raw_day_manifest_key": "k", "raw_day_manifest_sha256": "a" * 64}
    conversion = {k: "b" * 64 for k in ("converter_build_id", "dependency_lock_hash", "writer_configuration_hash", "target_platform_contract")}
    data = [b"part one", b"part two!"]
    part = lambda k, before, last: {"canonical_row_bytes": 9, "row_count": 5, "part_bytes": len(data[k]), "part_key": f"objects/part-{k}.parquet", "part_sha256": C.sha(data[k]).hex(), "first_stream_sequence": 5 * k, "last_stream_sequence": 5 * k + 4, "previous_row_chain_hash": before, "first_row_chain_hash": "d" * 64, "last_row_chain_hash": last}
    parts = publication.part_manifests(scope, conversion, [part(0, D.ZERO.hex(), "1" * 64), part(1, "1" * 64, "2" * 64)])
    day = publication.replay_day_manifest(scope, conversion, parts, 1, None, "provisional")
    store = FolderStore(str(tmp_path / "store"))
    for key, body in [(day["key"], day["bytes"]), *((p["key"], p["bytes"]) for p in parts), *((f"objects/part-{k}.parquet", d) for k, d in enumerate(data))]:
        store.put_if_absent(key, body)
    (tmp_path / "raw").mkdir()
    (tmp_path / "scopes.json").write_text('{"scope_key": "s", "dataset_id": "demo", "provider_id": "v", "symbol": "x"}\n')
    config = tmp_path / "reader.toml"
    config.write_text(f'raw_manifests = "{tmp_path}/raw"\nscopes = "{tmp_path}/scopes.json"\nreplay_manifests = "{tmp_path}/store"\npart_manifests = "{tmp_path}/store"\nexact = true\n')
    for k, (selector, kind) in enumerate([(day["digest"], "auto"), (day["key"], "auto"), (day["digest"], "replay")]):
        into = tmp_path / f"out{k}"
        assert cli.main(["--config", str(config), "--kind", kind, "fetch", "demo", selector, str(tmp_path / "store"), str(into)], spark) == 0
        items = json.loads(capsys.readouterr().out)["items"]
        assert sorted(i["key"] for i in items) == ["objects/part-0.parquet", "objects/part-1.parquet"] and all(i["created"] for i in items)
        assert [(into / f"objects/part-{n}.parquet").read_bytes() for n in range(2)] == data
    assert cli.main(["--config", str(config), "--kind", "raw", "fetch", "demo", day["digest"], str(tmp_path / "store"), str(tmp_path / "none")], spark) == 2
    assert cli.main(["--config", str(config), "fetch", "demo", "0" * 64, str(tmp_path / "store"), str(tmp_path / "none")], spark) == 2

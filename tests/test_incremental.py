"""Commits by several writers, and days folded from new segments only."""

import shutil
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.operators import archive
from tidemark.plans import events as E
from tidemark.plans import raw_days as Q
from tidemark.sources.commits import Commits, Conflict
from tidemark.sources.store import FolderStore
from tidemark.streaming.incremental import DayTables, fold_stream

SF = "/root/testdata/sf0.001"


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def values(df):
    return sorted(r["n"] for r in df.collect())


def test_two_writers_lose_nothing(spark, tmp_path):
    """Both write at the same time; each claims its own numbers, and no row is lost or doubled."""
    bad = []

    def work(start):
        try:
            log = Commits(spark, str(tmp_path), every=4)
            for k in range(6):
                log.commit({"t": rows(spark, start + k)}, token=(f"w{start}", k))
        except Exception as e:
            bad.append(e)

    threads = [threading.Thread(target=work, args=(s,)) for s in (0, 100)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    log = Commits(spark, str(tmp_path), every=4)
    assert not bad and log.known().count == 12 and values(log.table("t")) == [*range(6), *range(100, 106)] and log.count("t") == 12
    assert log.commit({"t": rows(spark, 7)}, token=("w0", 5)) is None and log.known().count == 12


def test_reading_opens_only_what_follows_the_snapshot(spark, tmp_path, monkeypatch):
    log = Commits(spark, str(tmp_path), every=4)
    for k in range(23):
        log.commit({"t": rows(spark, k), "now": rows(spark, 1000 + k)}, replaced=["now"])
    opened, real = [], FolderStore.get
    monkeypatch.setattr(FolderStore, "get", lambda self, key, *a: opened.append(key) or real(self, key, *a))
    monkeypatch.setattr(FolderStore, "keys", lambda *a: pytest.fail("nothing is listed"))
    assert Commits(spark, str(tmp_path), every=4).known().count == 23
    assert sum(k.startswith("commits") for k in opened) <= 4 and len(opened) < 16
    assert values(log.table("t")) == list(range(23)) and values(log.table("now")) == [1022]


def test_a_lost_snapshot_is_written_again(spark, tmp_path):
    log = Commits(spark, str(tmp_path), every=2)
    for k in range(6):
        log.commit({"t": rows(spark, k)})
    for k in (2, 3):
        (tmp_path / f"snapshots/{k:012d}").unlink()
    assert log.known().count == 6 and sorted(p.name for p in (tmp_path / "snapshots").iterdir()) == [f"{k:012d}" for k in (1, 2, 3)]


def test_conflicts_and_crashes(spark, tmp_path, monkeypatch):
    """A commit that another overtakes goes on unless both are about the same session or replace the same table."""
    log, other = Commits(spark, str(tmp_path)), Commits(spark, str(tmp_path))
    log.commit({"t": rows(spark, 1)}, names=["a"])
    real = FolderStore.put_if_absent

    def overtaken(name, replaced=()):
        def put(self, key, data):
            monkeypatch.setattr(FolderStore, "put_if_absent", real)
            other.commit({"t": rows(spark, 50)}, names=[name], replaced=replaced)
            return real(self, key, data)

        monkeypatch.setattr(FolderStore, "put_if_absent", put)

    overtaken("b")
    assert log.commit({"t": rows(spark, 2)}, names=["a"]) == 2
    overtaken("a")
    with pytest.raises(Conflict, match="a"):
        log.commit({"t": rows(spark, 3)}, names=["a"])
    overtaken("z")
    with pytest.raises(Conflict, match="table"):
        log.commit({"t": rows(spark, 4)}, replaced=["t"])
    assert values(log.table("t")) == [1, 2, 50, 50, 50]  # what lost was written, but no commit names it
    assert log.fold("t", ["n"]) is not None and len(log.paths("t")) == 1 and values(log.table("t")) == [1, 2, 50, 50, 50] and log.count("t") == 5


def test_bounds_leave_out_data(spark, tmp_path):
    log = Commits(spark, str(tmp_path))
    for k in range(5):
        log.commit({"t": rows(spark, 10 * k, 10 * k + 5)}, bounds={"t": "n"})
    log.commit({"t": rows(spark)}, bounds={"t": "n"})
    assert len(log.paths("t", 12, 27)) == 2 and len(log.paths("t")) == 5 and log.paths("t", 6, 9) == []
    assert log.table("none", "x long").count() == 0


@pytest.fixture(scope="module")
def parts(spark):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Q, "OBJECT", 1)  # an object an entry
        yield tables_of(spark)


def tables_of(spark):
    found, _, own = Q.tables(spark, SF)
    dealt = own.select("symbol", "object_key", F.floor((F.col("start_sequence") - 1) / Q.OBJECT).cast("int").alias("batch"))
    return tuple(E.stored(x.join(dealt, ["symbol", "object_key"]).select(*x.columns, "batch"), "t", "batch") for x in (found, own)), found, own


def comparable(days):
    return sorted(map(str, days.select("symbol", "day", "accepted", "errors", "source_watermark", "capture_watermark", "first_sequence", "last_sequence", "start_root", "end_root", "objects", "chain_objects", "raw_set_root").collect()))


def test_days_from_new_segments_only(spark, parts, tmp_path):
    """Each tick's records are deleted once it is folded, so nothing old can be read; the days are those of all segments."""
    (records, objects), found, own = parts
    want = comparable(archive.raw_days(found, own, "symbol"))
    folder = records.inputFiles()[0].split("/batch=")[0].removeprefix("file:").replace("///", "/")
    shutil.copytree(folder, tmp_path / "records")
    mine = spark.read.schema(records.schema).parquet(str(tmp_path / "records"))
    days, many = DayTables(spark, str(tmp_path / "days"), ("symbol",)), objects.agg(F.max("batch")).first()[0] + 1
    assert many > 1
    for k in range(many):
        new = (spark.read.schema(mine.drop("batch").schema).parquet(str(tmp_path / f"records/batch={k}")), objects.where(F.col("batch") == k).drop("batch"))
        assert days.fold(k, *new) and not days.fold(k, *new)  # a tick that is run again changes nothing
        shutil.rmtree(tmp_path / f"records/batch={k}")
        touched = {(r["symbol"], r["day"]) for r in found.join(objects.where(F.col("batch") == k).select("symbol", "object_key"), ["symbol", "object_key"]).select("symbol", "day").distinct().collect()}
        assert {(r["symbol"], r["day"]) for r in days.days(since=k).select("symbol", "day").collect()} == touched
    assert comparable(days.days()) == want
    day = sorted(r["day"] for r in days.days().select("day").distinct().collect())[1]
    assert comparable(days.days(low=day, high=day)) == [x for x in want if f"day='{day}'" in x]


def test_a_lost_segment_stops_the_tick(spark, parts, tmp_path):
    _, found, own = parts
    days = DayTables(spark, str(tmp_path), ("symbol",))
    less = own.where(F.col("start_sequence") != Q.OBJECT + 1)
    with pytest.raises(Exception, match="does not continue"):
        days.fold(0, found.join(less, ["symbol", "object_key"], "left_semi"), less)
    assert days.log.known().count == 0
    first = own.where(F.col("start_sequence") == 1)
    assert days.fold(0, found.join(first, ["symbol", "object_key"], "left_semi"), first)
    with pytest.raises(Exception, match="does not continue"):
        days.fold(1, found.join(first, ["symbol", "object_key"], "left_semi"), first)  # known segments come again under another number


def test_days_of_a_stream(spark, parts, tmp_path):
    """Micro-batches of a stream, and a second run of it that finds nothing new."""
    _, found, own = parts
    folder = tmp_path / "in"
    for k in range(3):
        some = own.where(F.floor((F.col("start_sequence") - 1) / Q.OBJECT) == k)
        found.join(some, ["symbol", "object_key"], "left_semi").coalesce(1).write.parquet(str(folder / f"{k}"))
    days = DayTables(spark, str(tmp_path / "days"), ("symbol",))
    for _ in range(2):
        stream = spark.readStream.schema(found.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(folder))
        fold_stream(days, stream, Q.segments)
    some = own.where(F.floor((F.col("start_sequence") - 1) / Q.OBJECT) < 3)
    assert days.log.known().count == 3
    assert comparable(days.days()) == comparable(archive.raw_days(found.join(some, ["symbol", "object_key"], "left_semi"), some, "symbol"))

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def compare():
    """Spark rows against DuckDB's over the tables of a folder."""
    import duckdb

    def plain(x):
        if x is None or x != x:
            return ""
        if isinstance(x, float):
            return f"{x:.10g}"
        return str(x)

    def run(frame, sql, folder):
        con = duckdb.connect()
        con.execute("set timezone = 'UTC'")
        for p in pathlib.Path(folder).glob("*.parquet"):
            con.execute(f"create view {p.stem} as select * from read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
        theirs = con.execute(sql)
        names = [d[0] for d in theirs.description]
        assert sorted(frame.columns) == sorted(names)
        order = sorted(names)
        left = sorted(tuple(plain(r[c]) for c in order) for r in frame.collect())
        right = sorted(tuple(plain(v[names.index(c)]) for c in order) for v in theirs.fetchall())
        assert left == right

    return run

"""Running counts, sums and exclusive-ors over sorted rows, in segments that may span any number of tasks.

Each task scans its range of the sorted rows as a stream. What a range leaves open at its end, one small row a
task, is carried into the next ones, so no segment, however long, has to lie in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written


def scanned(ordered: DataFrame, segment: str | None = None, sums: Sequence[str] = (), xors: Sequence[str] = ()) -> DataFrame:
    """ordered, a table that orderBy() sorted by segment first, with at, the place from 0 of each row in its segment, and run_c, the running sum or exclusive-or of c, the row's own included.

    segment is a column of longs, or None for one segment of all rows; c are columns of longs. Nulls are
    not allowed in these columns. The order of equal rows is that of the sort. An empty table stays empty.
    """
    values = [*sums, *xors]
    kind = {**dict.fromkeys(sums, np.add), **dict.fromkeys(xors, np.bitwise_xor)}
    runs = [f"run_{c}" for c in values]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields), "_part int, _row long, _head boolean, _seg long, at long", *(f"{r} long" for r in runs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, last, head, count, carried = TaskContext.get().partitionId(), 0, None, True, 0, dict.fromkeys(values, 0)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            seg = np.zeros(n, np.int64) if segment is None else batch.column(segment).to_numpy()
            new = np.concatenate([[last is not None and seg[0] != last], seg[1:] != seg[:-1]])
            group = np.cumsum(new)  # 0: what goes on from the batch before
            begin = np.concatenate([[0], np.flatnonzero(new)])[group]
            at = np.arange(n) - begin + np.where(group == 0, count, 0)
            out = []
            for c in values:
                own = batch.column(c).to_numpy()
                total = kind[c].accumulate(own)
                before = np.concatenate([[0], total[:-1]])[begin]
                inner = total - before if kind[c] is np.add else total ^ before
                out.append(np.where(group == 0, kind[c](inner, carried[c]), inner))
            heads = (group == 0) & head
            columns = [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(row + np.arange(n)), pa.array(heads), pa.array(seg), pa.array(at), *(pa.array(x) for x in out)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_part", "_row", "_head", "_seg", "at", *runs])
            row, last, head, count, carried = row + n, seg[-1], bool(heads[-1]), int(at[-1]) + 1, {c: x[-1] for c, x in zip(values, out, strict=True)}

    rows = written(ordered.mapInArrow(run, schema), "scanned")
    state = F.struct("_seg", "_head", (F.col("at") + 1).alias("at"), *runs)
    tails = rows.groupBy("_part").agg(F.max_by(state, "_row").alias("t"), F.min_by("_seg", "_row").alias("first")).select("_part", "first", "t.*")
    by_part = Window.orderBy("_part")
    tails = tails.withColumn("begins", (~F.col("_head") | ~F.col("_seg").eqNullSafe(F.lag("_seg").over(by_part))).cast("int")).withColumn("chain", F.sum("begins").over(by_part))
    so_far = Window.partitionBy("chain").orderBy("_part")
    open_ = tails.select("_part", "first", "_seg", F.sum("at").over(so_far).alias("at"), *((F.sum if c in sums else F.bit_xor)(f"run_{c}").over(so_far).alias(f"run_{c}") for c in values))
    before = [F.lag(c).over(by_part) for c in ("_seg", "at", *runs)]
    carry = open_.select("_part", *(F.coalesce(F.when(before[0] == F.col("first"), x), F.lit(0)).alias(f"_in_{c}") for c, x in zip(("at", *runs), before[1:], strict=True)))
    carry = F.broadcast(written(carry, "carry"))  # one row a task
    joined = rows.join(carry, "_part", "left")

    def final(c: str):
        more = F.coalesce(F.col(f"_in_{c}"), F.lit(0))
        return F.when(F.col("_head"), F.col(c).bitwiseXOR(more) if c[4:] in xors and c != "at" else F.col(c) + more).otherwise(F.col(c)).alias(c)

    return joined.select(*(F.col(f"`{c}`") for c in ordered.columns), *(final(c) for c in ("at", *runs)))

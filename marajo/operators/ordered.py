"""Windows over one order of all rows, without a task that holds them all."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from marajo.session import small_side, stash

#: Rows of a block of :func:`over_order`.
BLOCK_ROWS = 1 << 18


def _running(weight: str):
    """Adds ``ahead``: the weight of the task's rows before each one."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far = 0
        for batch in batches:
            own = batch.column(weight)
            upto = pc.add(pc.cumulative_sum(own), so_far)
            yield pa.RecordBatch.from_arrays([*batch.columns, pc.subtract(upto, own)], [*batch.schema.names, "ahead"])
            so_far += pc.sum(own).as_py() or 0

    return walk


def positions(df: DataFrame, group: Sequence[str], order: Sequence[str], weight: str | None = None) -> DataFrame:
    """``df`` with ``pos``, the place of a row among those of its ``group`` in ascending ``order`` (nulls first, from 0),
    and ``of``, their number; with ``weight`` also ``before`` and ``total``, the sums over the rows before it and over all.

    ``df`` is read twice (Spark samples it for the ranges), so it should be a written table. Rows that tie in ``order``
    get places in any order: it should tell rows apart, which also lets ranges split a hot group. Each task numbers its
    stretch, and a table of one row per group and task carries the counts on. Null groups are a group; ``weight`` must not
    be null. The names ``at``, ``task``, ``ahead``, ``stretch`` and those of the result must be free.
    """
    keys = [*group, *order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    if weight:
        ranged = ranged.mapInArrow(_running(weight), f"{df._jdf.schema().toDDL()}, ahead BIGINT")
    ranged = stash(ranged.withColumn("at", F.monotonically_increasing_id()).withColumn("task", F.shiftright("at", 33)), "ranged")
    sums = [F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at")]
    if weight:
        sums += [F.sum(weight).alias("w"), F.min("ahead").alias("first_ahead")]
    counts = ranged.groupBy(*group, "task").agg(*sums)
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    gone = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    starts = [F.struct(*group, "task").alias("stretch"), (gone("n") - F.col("first_at")).alias("shift"), F.sum("n").over(whole).alias("of")]
    if weight:
        starts += [(gone("w") - F.col("first_ahead")).alias("ahead_shift"), F.sum("w").over(whole).alias("total")]
    joined = ranged.join(small_side(counts.select(*starts), "starts"), F.struct(*group, "task").eqNullSafe(F.col("stretch")))
    found = [*df.columns, (F.col("at") + F.col("shift")).alias("pos"), "of"]
    return joined.select(*found, *([(F.col("ahead") + F.col("ahead_shift")).alias("before"), "total"] if weight else []))


def over_order(df: DataFrame, order: Sequence[str], back: int, columns: Callable[[WindowSpec], Mapping[str, Column]]) -> DataFrame:
    """``df`` with window columns over the ascending ``order`` (nulls first) of all rows.

    ``columns`` makes them of a window, and may look back ``back`` rows at most. Rows are numbered by range and dealt into
    blocks of consecutive ones; the last ``back`` rows of a block go to the next one as well, whose first rows look back to
    them, and are left out of its result. A block is what a task holds, however many rows there are. ``order`` should tell
    rows apart, as a tie is settled in any way.
    """
    rows = max(BLOCK_ROWS, back)
    placed = positions(stash(df, "rows"), [], order)
    own = F.floor(F.col("pos") / rows)
    lent = (F.col("pos") % rows >= rows - back) & (F.col("pos") - F.col("pos") % rows + rows < F.col("of"))
    dealt = placed.withColumn("_block", F.explode(F.array_compact(F.array(own, F.when(lent, own + 1))))).withColumn("_own", F.col("_block") == own)
    found = dealt.withColumns(dict(columns(Window.partitionBy("_block").orderBy("pos"))))
    return found.where("_own").drop("_block", "_own", "pos", "of")

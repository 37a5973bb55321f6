"""Counts that a load makes of itself: rejected values, null keys and repeated keys, from the scan that writes the table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from marajo.session import unfused

#: What stands for "no value" in the raw files; such text is not rejected.
NO_VALUE = ("", "None", "NaN", "-", "..", "...")


@dataclass(frozen=True)
class LoadCounts:
    """``rejected``: by column, the values with text that their type didn't take. ``distinct_keys`` is an estimate (five percent);
    ``rows - null_keys - distinct_keys`` is about the number of rows that repeat a key."""

    rows: int
    rejected: dict[str, int]
    null_keys: int
    distinct_keys: int

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame([(c, n, self.rows) for c, n in self.rejected.items()], "column_name string, rejected long, n_rows long")


def _is_text(c: Column) -> Column:
    return c.isNotNull() & ~F.trim(c).isin(*NO_VALUE)


def load_observed(raw: DataFrame, columns: Sequence[tuple[Sequence[str], str, Column]], path: str, keys: Sequence[str] = ()) -> LoadCounts:
    """Write the typed columns to ``path`` (which must be free) and say what became of the text, in one scan.

    ``columns`` lists (raw names, typed name, typed column): a value is rejected if any of its raw columns has text and the typed
    one is null. Every task counts its rows; only the sums come to the driver. Spark reports them once the write succeeded,
    and a task that was repeated counts once.
    """
    watch, has = Observation(), set(raw.columns)
    read = {n: f"text_{i}" for i, n in enumerate(dict.fromkeys(n for names, _, _ in columns for n in names if n in has))}
    value = {name: f"value_{i}" for i, (_, name, _) in enumerate(columns)}
    both = raw.select(*[made.alias(value[name]) for _, name, made in columns], *[F.col(n).alias(text) for n, text in read.items()])
    counts = [F.count_if(F.col(value[name]).isNull() & _any_text([read[n] for n in names if n in has])).alias(f"rejected_{i}") for i, (names, name, _) in enumerate(columns)]
    key = [F.col(value[k]) for k in keys]
    missing = reduce(lambda a, b: a | b, [k.isNull() for k in key], F.lit(False))
    seen = F.approx_count_distinct(F.when(~missing, F.struct(*key))) if key else F.count(F.lit(None))
    held = both.observe(watch, F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("null_keys"), seen.alias("distinct_keys"), *counts)
    with unfused(raw.sparkSession):
        held.select(*[F.col(value[name]).alias(name) for _, name, _ in columns]).write.parquet(path)
    got = watch.get
    return LoadCounts(got["rows"], {name: got[f"rejected_{i}"] for i, (_, name, _) in enumerate(columns)}, got["null_keys"], got["distinct_keys"])


def _any_text(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [_is_text(F.col(n)) for n in names], F.lit(False))


def unique_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``; a job that reads it fails if two of its rows share a key. Rows with a null key are let be.

    The check is in the plan: a window over the keys, which a join on them needs to be dealt by anyway.
    """
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    text = F.concat(F.lit(f"more than one row of a key of {list(keys)}: "), F.to_json(F.struct(*keys)))
    return df.withColumn("_place", place).where(F.when(missing | (F.col("_place") == 1), True).otherwise(F.raise_error(text).isNull())).drop("_place")

"""Line dedup over overlapping windows of three lines, in DataFrame functions only.

Every window of consecutive lines is hashed to 128 bits; windows that occur more than once anywhere lose all
occurrences but the first (by document id, then position), and the lines that those later occurrences cover are
merged into one set of positions per document and removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def later_windows(docs: DataFrame, window: int = 3) -> DataFrame:
    """``doc_id``, ``tag`` (hash of the text) and ``at`` (first line) of each window that occurred before."""
    base = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"), _lines(F.col("text")).alias("lines")
    )
    base = base.where(F.size("lines") >= window)

    def hashed(i: Column) -> Column:
        part = F.slice(F.col("lines"), i + 1, F.lit(window))
        return F.struct(F.xxhash64(part).alias("h1"), F.xxhash64(F.lit(1), part).alias("h2"))

    starts = F.sequence(F.lit(0), F.size("lines") - window)
    seen = base.select("doc_id", "tag", F.posexplode(F.transform(starts, hashed)).alias("at", "h"))
    seen = seen.select("doc_id", "tag", "at", "h.h1", "h.h2")
    place = F.struct("doc_id", "tag", "at")
    first = seen.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    again = seen.join(first.where(F.col("n") > 1).drop("n"), ["h1", "h2"])
    return again.where(~place.eqNullSafe(F.col("first"))).select("doc_id", "tag", "at")


def dedup_lines(docs: DataFrame, window: int = 3) -> DataFrame:
    """``docs`` with every column as it was but ``text``, which loses repeated lines, plus ``n_lines`` and
    ``n_removed``.

    Lines end at line feeds and are compared as they are. Texts of fewer than ``window`` lines stay, null stays
    null (no lines), an empty text is one line. Windows may overlap: of a line that stands four times in a row
    one copy stays, as its second window already occurred. A null id comes first in order. Rows that repeat
    both id and text count as one place and get the same result. Columns of ``docs`` named ``n_lines`` or
    ``n_removed`` are replaced. An empty table gives no rows.
    """
    covered = F.array_distinct(F.flatten(F.transform(F.collect_set("at"), lambda i: F.sequence(i, i + window - 1))))
    gone = later_windows(docs, window).groupBy(F.struct("doc_id", "tag").alias("gone_key")).agg(covered.alias("gone_lines"))
    # the rows travel in a struct, so that no column of theirs can clash
    packed = docs.select(F.struct(*docs.columns).alias("row"))
    key = F.struct(F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64("row.text").alias("tag"))
    joined = packed.join(gone, key == F.col("gone_key"), "left").select(
        "row", "gone_lines", F.coalesce(F.when(F.col("row.text").isNotNull(), F.size(_lines(F.col("row.text")))), F.lit(0)).alias("own_lines")
    )
    lines = F.when(F.col("gone_lines").isNotNull(), _lines(F.col("row.text"))).alias("split_lines")
    kept_at = F.array_except(F.sequence(F.lit(0), F.col("own_lines") - 1), F.col("gone_lines"))
    left = F.array_join(F.transform(kept_at, lambda i: F.get(F.col("split_lines"), i)), "\n")
    text = F.when(F.col("gone_lines").isNull(), F.col("row.text")).otherwise(left)
    plain = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select("*", lines).select(
        *[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in plain],
        F.col("own_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone_lines"), F.lit(0)).cast("long").alias("n_removed"),
    )

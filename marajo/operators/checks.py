"""Data-quality checks (they return the failures), model metadata, and comparison of file listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marajo.operators.loading import upsert


def check_row_count(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row with both counts if they differ, else none."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return count(a, "source_rows").crossJoin(count(b, "target_rows")).where("source_rows <> target_rows")


def check_types(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Columns whose type isn't the expected one; a missing column has a null type."""
    actual = dict(df.dtypes)
    rows = [(c, kind, actual.get(c)) for c, kind in expected.items() if actual.get(c) != kind]
    return df.sparkSession.createDataFrame(rows, "column_name string, expected_type string, actual_type string")


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def check_unique(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Values that stand more than once, with their count; nulls aren't compared."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.dropna("any", subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def record_model_metadata(store: DataFrame, rows: DataFrame, order: str = "executed_at") -> DataFrame:
    """Metadata by (schema_name, table_name): the newest of each, columns of either side kept."""
    return upsert(store, rows, ["schema_name", "table_name"], order)


# --- file listings ------------------------------------------------------------------------------------------


def comparison_key(path: Column, mode: str = "path") -> Column:
    """Path without leading ``./`` and slashes, or the file name only."""
    plain = F.regexp_replace(F.regexp_replace(path, r"^\./", ""), "^/+", "")
    return F.substring_index(plain, "/", -1) if mode == "filename" else plain


def diff_snapshots(old: DataFrame, new: DataFrame, compare_mtime: bool = True) -> DataFrame:
    """``path``, ``status`` (added, removed, modified, unchanged), sizes and times of both sides.

    With ``compare_mtime=False`` only a change of size modifies a file.
    """
    side = lambda df, s: df.select("path", F.col("size").alias(f"{s}_size"), F.col("mtime").alias(f"{s}_mtime"), F.lit(True).alias(f"_{s}"))
    both = side(old, "old").join(side(new, "new"), "path", "full")
    changed = ~F.col("old_size").eqNullSafe(F.col("new_size"))
    if compare_mtime:
        changed = changed | ~F.col("old_mtime").eqNullSafe(F.col("new_mtime"))
    status = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(changed, "modified").otherwise("unchanged")
    return both.withColumn("status", status).drop("_old", "_new")


def _numbered(df: DataFrame) -> DataFrame:
    w = Window.partitionBy("name", "size").orderBy("path")
    return df.withColumn("n", F.row_number().over(w))


def detect_moves(diff: DataFrame) -> DataFrame:
    """``from_path``, ``to_path``, ``size``: removed files paired with added ones of equal name and size, one to one in
    order of path."""
    name = F.substring_index("path", "/", -1).alias("name")
    gone = _numbered(diff.where("status = 'removed'").select("path", name, F.col("old_size").alias("size"))).withColumnRenamed("path", "from_path")
    came = _numbered(diff.where("status = 'added'").select("path", name, F.col("new_size").alias("size"))).withColumnRenamed("path", "to_path")
    return gone.join(came, ["name", "size", "n"]).select("from_path", "to_path", "size")


def detect_copies(diff: DataFrame) -> DataFrame:
    """Added files, not moved, that equal a file still there in name and size (the first by path)."""
    name = F.substring_index("path", "/", -1).alias("name")
    stays = diff.where("status in ('modified', 'unchanged')").select("path", name, F.col("new_size").alias("size"))
    source = stays.groupBy("name", "size").agg(F.min("path").alias("from_path"))
    moved = detect_moves(diff).select(F.col("to_path").alias("path"))
    came = diff.where("status = 'added'").select("path", name, F.col("new_size").alias("size")).join(moved, "path", "left_anti")
    return came.join(source, ["name", "size"]).select("from_path", F.col("path").alias("to_path"), "size")


def classified_changes(diff: DataFrame) -> DataFrame:
    """``diff`` with moved and copied files told from added and removed ones."""
    moves, copies = detect_moves(diff), detect_copies(diff)
    tags = (
        moves.select(F.col("to_path").alias("path"), F.lit("moved").alias("tag"))
        .unionByName(moves.select(F.col("from_path").alias("path"), F.lit("moved away").alias("tag")))
        .unionByName(copies.select(F.col("to_path").alias("path"), F.lit("copied").alias("tag")))
    )
    return diff.join(tags, "path", "left").withColumn("status", F.coalesce("tag", "status")).drop("tag")


def summarize_changes(diff: DataFrame) -> DataFrame:
    """One row: counts by kind of change, and ``pattern``: the ways the share seems to be updated, in order."""
    told = classified_changes(diff)
    n = lambda s: F.count_if(F.col("status") == s)
    counts = told.agg(*[n(s).alias(s) for s in ("modified", "moved", "copied", "added", "removed", "unchanged")])
    c = {s: F.col(s) > 0 for s in ("modified", "moved", "copied", "added", "removed")}
    signs = [
        F.when(c["modified"], "overwrite"), F.when(c["moved"], "archive by move"), F.when(c["copied"], "archive by copy"),
        F.when(c["added"] & ~c["modified"] & ~c["moved"], "append"), F.when(c["removed"], "delete"),
    ]
    return counts.withColumn("pattern", F.coalesce(F.nullif(F.concat_ws(", ", *signs), F.lit("")), F.lit("nothing changed")))

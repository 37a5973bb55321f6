"""Readers and sinks: staging parquet, text drops of unknown dialect, positional extracts, JSON report documents."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marajo.operators.loading import full_refresh, normal_names, swap_in, upsert
from marajo.operators.stored import upsert_into
from marajo.session import BROADCAST_ROWS, small_side, stash
from marajo.sources import quoted


def read_staging(spark: SparkSession, root: str, source: str, name: str) -> DataFrame:
    """One typed dataset of the staging area."""
    return spark.read.parquet(f"{root.rstrip('/')}/{source}/{name}.parquet")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def to_staging(source: DataFrame | str, fmt: str, typers: Mapping[str, Callable[[Column], Column]], out: str, spark: SparkSession | None = None, sep: str = ",") -> bool:
    """Raw text (a frame, or a path to ``csv``, ``txt`` with ``sep``, or ``json``) to typed parquet, whole refresh.

    ``typers`` maps columns to their cast; other columns become text. Without a row nothing is written; returns
    whether there was any.
    """
    if isinstance(source, str):
        reader = spark.read
        raw = reader.json(source) if fmt == "json" else reader.csv(source, header=True, sep=sep)
    else:
        raw = source
    typed = raw.select(*[typers[c](F.col(c)).alias(c) if c in typers else F.col(c).cast("string").alias(c) for c in raw.columns])
    if not typed.take(1):
        return False
    full_refresh(typed, out)
    return True


def _lines(spark: SparkSession, glob: str, **options: str) -> DataFrame:
    """``file``, ``block`` (where the split of the file starts), ``id`` (increasing within a split) and ``text`` of every
    line; the bytes are as they are in the file."""
    held = spark.read.options(**options).text(glob)
    return held.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("text"))


def infer_dialect(lines: DataFrame) -> DataFrame:
    """``file``, ``encoding`` (utf-8, or ISO-8859-1 if any line isn't valid), ``sep`` and ``header`` (the first line, as
    bytes) of the files whose ``lines`` are given as :func:`quoted.raw_lines` has them.

    The separator is the first of ``; , | tab`` in the header line, a comma without any. Files are scanned in splits and
    only a row of each split leaves the scan.
    """
    return quoted.splits(lines).select("file", "encoding", "sep", "header").distinct()


def _header_names(header: bytes, encoding: str, sep: str) -> list[str]:
    text = bytes(header).decode(encoding)
    return [n.strip().strip('"') or f"Unnamed: {i}" for i, n in enumerate(text.split(sep))]


def read_delimited_drop(spark: SparkSession, glob: str) -> DataFrame:
    """All columns of all files as text, names normalised, malformed records dropped, ``source_path`` beside them.

    Two scans, however many files, dialects and headers there are: one tells the dialects and the quotes of every split, one
    cuts records and parses them by their file's; where records cross splits it is looked at again for their fragments.
    Only the distinct headers come to the driver. Quoted cells may hold separators, line feeds and doubled quotes; a quote
    inside a cell that has none at its start is itself. A file's header is one line, and lines that equal it are left out
    wherever they stand; a record with another number of cells than its header is malformed, as is one that is never closed.
    Lines end at line feeds, with or without a carriage return.
    """
    try:
        return delimited(quoted.raw_lines(spark, glob))
    except LookupError:
        raise FileNotFoundError(glob) from None


def delimited(lines: DataFrame) -> DataFrame:
    """:func:`read_delimited_drop` of lines that are there already: ``file``, ``block``, ``id`` and ``text``, those of a block in
    the order of ``id`` and in one partition."""
    told = stash(quoted.splits(lines), "splits")
    kinds = told.select("encoding", "sep", "header").distinct().collect()
    if not kinds:
        raise LookupError("no lines")
    named = {(k.encoding, k.sep, bytes(k.header)): _header_names(k.header, k.encoding, k.sep) for k in kinds}
    kind = F
    for i, key in enumerate(named):
        kind = kind.when((F.col("encoding") == key[0]) & (F.col("sep") == key[1]) & (F.col("header") == F.lit(key[2])), i)
    few = told.count() <= BROADCAST_ROWS
    sides = told.withColumn("kind", kind)
    held = quoted.records(lines, F.broadcast(sides) if few else sides, few)

    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("kind"))
    encoding, sep_, header = zip(*named, strict=True)
    record = F.regexp_replace(F.hex("text"), "^EFBBBF|0D$", "")
    dialect = held.select("file", "kind", F.unhex(record).alias("raw"), pick(encoding).alias("encoding"), pick(sep_).alias("sep"), pick(map(len, named.values())).alias("width"), pick(header).alias("header"))
    text = F.when(F.col("encoding") == "utf-8", F.col("raw").cast("string")).otherwise(F.decode("raw", "ISO-8859-1"))
    cells = F
    for sep, width in sorted({(key[1], len(names)) for key, names in named.items()}):
        schema = ", ".join(f"_{i} string" for i in range(width)) + ", _bad string"
        row = F.from_csv(text, schema, {"sep": sep, "columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE", "escape": '"'})
        good = F.when(row["_bad"].isNull(), F.array(*[row[f"_{i}"] for i in range(width)]))
        cells = cells.when((F.col("sep") == sep) & (F.col("width") == width), good)
    parsed = dialect.where(F.col("raw") != F.col("header")).select("file", "kind", cells.alias("cells")).where("cells is not null")
    places = [dict((n, i) for i, n in normal_names(names)) for names in named.values()]
    columns = list(dict.fromkeys(n for own in places for n in own))
    at = lambda n: F.get(F.array(*[F.lit(own.get(n)).cast("int") for own in places]), F.col("kind"))
    return parsed.select(*[F.get("cells", at(n)).alias(n) for n in columns], F.col("file").alias("source_path"))


def numbered_lines(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """``file``, ``line_no`` from 1 and ``text`` of every line, decoded.

    Files are read in splits; the lines are written once with the split they stand in, and a table of one count per split
    gives the number of each split's first line. ``utf-16`` is little-endian under a byte order mark; its lines end at the
    byte pair of a line feed.
    """
    wide = encoding.lower().replace("_", "-").startswith("utf-16")
    charset = {"utf-16": "UTF-16LE"}.get(encoding.lower(), encoding.upper())
    held = stash(_lines(spark, path, **({"encoding": charset, "lineSep": "\n"} if wide else {})), "lines")
    counts = held.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    raw = F.col("text").cast("binary")
    text = F.col("text") if charset == "UTF-8" else F.decode(raw, charset)
    text = F.regexp_replace(F.regexp_replace(text, "^\ufeff", ""), "\r$", "")
    found = held.join(small_side(starts, "starts"), ["file", "block"])
    return found.select("file", (F.col("id") + F.col("shift")).cast("long").alias("line_no"), text.alias("text"))


def read_positional(spark: SparkSession, path: str, mapping: Mapping[int, str], skiprows: int = 0, sep: str = "\t", encoding: str = "utf-16", width: int | None = None) -> DataFrame:
    """Delimited lines by position: names from ``mapping``, else ``col_i``; the first ``skiprows`` lines and empty ones go."""
    lines = numbered_lines(spark, path, encoding)
    return positional(lines, mapping, skiprows, sep, width)


def positional(lines: DataFrame, mapping: Mapping[int, str], skiprows: int = 0, sep: str = "\t", width: int | None = None) -> DataFrame:
    n = width or max(mapping) + 1
    cells = lines.where((F.col("line_no") > skiprows) & (F.trim("text") != "")).withColumn("_c", F.split("text", f"\\Q{sep}\\E", -1))
    return cells.select("file", "line_no", *[F.trim(F.get("_c", F.lit(i))).alias(mapping.get(i, f"col_{i}")) for i in range(n)])


def replicate_tables(spark: SparkSession, config: Mapping[str, Sequence[str]], read: Callable[[str], DataFrame], target: Callable[[str], DataFrame], order: str) -> dict[str, DataFrame]:
    """Each configured table read whole (``read`` may be :func:`scan_source`) and upserted to its target by primary key."""
    return {name: upsert(target(name), read(name), keys, order) for name, keys in config.items()}


def scan_source(spark: SparkSession, url: str, table: str, key: str, tasks: int = 16, fetch: int = 10_000, **options: str) -> DataFrame:
    """A table of a source database over JDBC, read by ``tasks`` tasks at once, each a range of the numeric ``key``.

    The bounds are the key's quantiles, asked of the source by a query over the key alone, so ranges hold about equal numbers
    of rows however the key is spread. The ranges cover everything: the first has null keys and all below, the last
    all above. An empty table gives an empty frame.
    """
    ask = lambda query: spark.read.format("jdbc").options(url=url, query=query, fetchsize=str(fetch), **options).load()
    keys = ask(f"select {key} as k from {table}")
    bounds = keys.select(F.percentile_approx(F.col("k").cast("long"), [i / tasks for i in range(1, tasks)], 10_000)).first()[0] or []
    cuts = sorted(set(bounds))
    if not cuts:
        where = ["1 = 1"]
    else:
        inner = [f"{key} > {a} and {key} <= {b}" for a, b in zip(cuts, cuts[1:])]
        where = [f"{key} <= {cuts[0]} or {key} is null", *inner, f"{key} > {cuts[-1]}"]
    return spark.read.jdbc(url, table, predicates=where, properties={"fetchsize": str(fetch)} | options)


def replicate(spark: SparkSession, url: str, config: Mapping[str, Sequence[str]], root: str, tasks: int = 16, **options: str) -> None:
    """Every configured table of a source database loaded into its keyed target under ``root``; the first key cuts the scan."""
    for name, keys in config.items():
        rows = scan_source(spark, url, name, keys[0], tasks, **options)
        upsert_into(f"{root.rstrip('/')}/{name}", rows, [c for c in rows.columns if c.lower() in {k.lower() for k in keys}], rows.columns[0])


#: Rows of a frame of a report at most.
REPORT_ROWS = 10_000


def report_document(
    frames: Mapping[str, DataFrame], maps: Mapping[str, tuple[str, str]] = {}, defaults: Mapping[str, dict] = {}, order: Mapping[str, Sequence[Column | str]] = {}
) -> DataFrame:
    """One row ``document``: a JSON object with a member for each frame.

    A frame in ``maps`` (key and value column) becomes an object, one in ``defaults`` its only row with nulls
    replaced, any other a list of its rows, ascending by the expressions in ``order``, else by its columns. Frames are
    reports, small by nature: a job that finds one of more than ``REPORT_ROWS`` fails, having read so many and one. Nothing
    runs before the document is asked for, and then everything at once.
    """
    parts = []
    for name, frame in frames.items():
        few = frame.limit(REPORT_ROWS + 1)
        if name in maps:
            key, value = maps[name]
            part = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key).cast("string"), F.col(value)))))
        elif name in defaults:
            part = F.struct(*[F.coalesce(F.max(c), F.lit(v)).alias(c) for c, v in defaults[name].items()])
        else:
            keys = [(F.col(k) if isinstance(k, str) else k).alias(f"k{i}") for i, k in enumerate(order.get(name, frame.columns))]
            rows = F.sort_array(F.collect_list(F.struct(F.struct(*keys).alias("at"), F.struct(*frame.columns).alias("row"))))
            part = F.transform(rows, lambda r: r["row"])
        made = few.agg(part.alias("part"), F.count(F.lit(1)).alias("n"))
        whole = F.when(F.col("n") <= REPORT_ROWS, F.col("part")).otherwise(F.raise_error(F.lit(f"{name} is no report: more than {REPORT_ROWS} rows")))
        parts.append(made.select(whole.alias(name)))
    joined = reduce(lambda a, b: a.crossJoin(b), parts)
    return joined.select(F.to_json(F.struct(*frames)).alias("document"))


def write_document(document: DataFrame, path: str) -> None:
    """Put the document into the one file ``path``. It is written aside whole and then swapped in, so a reader finds the old
    document or the new one, and a job that fails leaves the last good one."""
    spark, root = document.sparkSession, path.rstrip("/")
    aside = f"{root}.{uuid.uuid4().hex}.new"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    folder = hadoop(aside)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        document.coalesce(1).write.text(aside)
        parts = [s.getPath() for s in store.listStatus(folder) if s.getPath().getName().startswith("part-") and s.getLen() > 0]
        if len(parts) != 1:
            raise ValueError(f"{len(parts)} files in place of one document")
        swap_in(spark, parts[0].toString(), root)
    finally:
        store.delete(folder, True)

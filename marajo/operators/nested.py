"""Nested records, API payloads, XML documents and sheets to tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_nested(df: DataFrame, sep: str = "__") -> DataFrame:
    """Structs to columns ``a__b`` at any depth, arrays and maps to JSON text."""

    def walk(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out = []
        for f in schema.fields:
            here = (*path, f.name)
            col = F.col(".".join(f"`{p}`" for p in here))
            if isinstance(f.dataType, T.StructType):
                out += walk(f.dataType, here)
            elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
                out.append(F.to_json(col).alias(sep.join(here)))
            else:
                out.append(col.alias(sep.join(here)))
        return out

    return df.select(*walk(df.schema, ()))


def project_nested(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Chosen nested fields under new names; ``mapping`` is new name to dotted path."""
    return df.select(*[F.col(path).alias(name) for name, path in mapping.items()])


def explode_series_payload(df: DataFrame) -> DataFrame:
    """Statistical API payload to its twelve-column long table (without the stamp).

    Rows have ``id``, ``variavel``, ``unidade`` and ``resultados`` (classifications, and series with a place and a
    map from period to value). Ids and names of several classifications are joined by a bar; without any they are
    ``0`` and empty. The value ``...`` becomes null.
    """
    per_result = df.select("id", "variavel", "unidade", F.explode("resultados").alias("r"))
    per_series = per_result.select("id", "variavel", "unidade", F.col("r.classificacoes").alias("cs"), F.explode("r.series").alias("s"))
    rows = per_series.select("*", F.explode("s.serie").alias("periodo", "valor"))
    joined = lambda f: F.array_join(F.transform("cs", f), "|")
    none = F.coalesce(F.size("cs"), F.lit(0)) <= 0
    first = lambda m: F.try_element_at(F.map_keys(m), F.lit(1))
    label = lambda m: F.try_element_at(F.map_values(m), F.lit(1))
    return rows.select(
        F.col("id").alias("variavel_id"),
        F.col("variavel").alias("variavel_nome"),
        F.col("s.localidade.id").alias("localidade_id"),
        F.col("s.localidade.nome").alias("localidade_nome"),
        F.when(none, "0").otherwise(joined(lambda c: c["id"])).alias("classificacao_id"),
        F.when(none, "").otherwise(joined(lambda c: c["nome"])).alias("classificacao_nome"),
        F.when(none, "0").otherwise(joined(lambda c: first(c["categoria"]))).alias("categoria_id"),
        F.when(none, "").otherwise(joined(lambda c: label(c["categoria"]))).alias("categoria_nome"),
        F.col("unidade").alias("unidade"),
        "periodo",
        F.when(F.col("valor") != "...", F.col("valor")).alias("valor"),
    )


def explode_date_map(df: DataFrame, col: str, fields: Mapping[str, tuple[str, str]], ids: Sequence[str] = (), min_date: str | None = None) -> DataFrame:
    """Map from date to struct as rows: ``date`` and the fields renamed and cast (new name to old name and type);
    rows before ``min_date``, and keys that are no date, go."""
    rows = df.select(*ids, F.explode(col).alias("_k", "_v")).withColumn("date", F.try_to_date("_k"))
    rows = rows.where(F.col("date").isNotNull() if min_date is None else F.col("date") >= F.lit(min_date).cast("date"))
    return rows.select(*ids, "date", *[F.col(f"_v.{old}").try_cast(kind).alias(new) for new, (old, kind) in fields.items()])


def drop_header_record(df: DataFrame, records: str, mapping: Mapping[str, str], ids: Sequence[str] = ()) -> DataFrame:
    """Rows of an array of maps whose first element is the header; code columns are renamed (code to name)."""
    rows = df.select(*ids, F.posexplode(records).alias("_pos", "_r")).where("_pos > 0")
    return rows.select(*ids, *[F.col("_r").getItem(code).alias(name) for code, name in mapping.items()])


# --- XML ----------------------------------------------------------------------------------------------------


def strip_namespaces(xml: Column) -> Column:
    """XML text without namespace prefixes and declarations."""
    bare = F.regexp_replace(xml, r"(</?)[A-Za-z_][\w.-]*:", "$1")
    return F.regexp_replace(bare, r"""\s+(?:xmlns(?::[\w.-]+)?|[A-Za-z_][\w.-]*:[\w.-]+)\s*=\s*(?:"[^"]*"|'[^']*')""", "")


def elements(xml: Column, name: str) -> Column:
    """Texts of the elements of a name, in order; elements of the name don't nest."""
    return F.regexp_extract_all(strip_namespaces(xml), F.lit(rf"(?s)<{name}(?:\s[^>]*)?>.*?</{name}>"), F.lit(0))


def _blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def _parsed(col: Column, fields: Sequence[str], name: str, child: str | None = None, child_fields: Sequence[str] = ()) -> Column:
    kinds = [f"`{f}` string" for f in fields]
    if child:
        inner = ", ".join(f"`{f}`: string" for f in child_fields)
        kinds.append(f"`{child}` array<struct<{inner}>>")
    return F.from_xml(col, ", ".join(kinds), {"rowTag": name})


def xml_rows(df: DataFrame, xml: str, element: str, fields: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """A row for each repeated element, its fields trimmed and blank ones null."""
    rows = df.select(*ids, F.explode(elements(F.col(xml), element)).alias("_e")).withColumn("_p", _parsed(F.col("_e"), fields, element))
    return rows.select(*ids, *[_blank_to_null(F.col(f"_p.{f}")).alias(f) for f in fields])


def xml_parent_child(
    df: DataFrame, xml: str, element: str, fields: Sequence[str], child: str, child_fields: Sequence[str], ids: Sequence[str] = (), keep_childless: bool = True
) -> DataFrame:
    """A row for each nested child with its parent's fields; a parent without any gives one row, or none."""
    rows = df.select(*ids, F.explode(elements(F.col(xml), element)).alias("_e"))
    rows = rows.withColumn("_p", _parsed(F.col("_e"), fields, element, child, child_fields))
    explode = F.explode_outer if keep_childless else F.explode
    rows = rows.select(*ids, "_p", explode(f"_p.{child}").alias("_c"))
    return rows.select(
        *ids, *[_blank_to_null(F.col(f"_p.{f}")).alias(f) for f in fields], *[_blank_to_null(F.col(f"_c.{f}")).alias(f"{child}__{f}") for f in child_fields]
    )


def xml_union_elements(df: DataFrame, xml: str, kinds: Mapping[str, Sequence[str]], ids: Sequence[str] = ()) -> DataFrame:
    """Elements of several kinds in one table, told apart by ``element``; fields a kind lacks are null, nested
    arrays that aren't listed are skipped."""
    out = None
    for name, fields in kinds.items():
        part = xml_rows(df, xml, name, fields, ids).withColumn("element", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


# --- lines and sheets ---------------------------------------------------------------------------------------


#: Lines of a file that one task puts in order.
BLOCK_LINES = 65_536


def sectioned_report(
    lines: DataFrame, header: str, skip: int = 5, min_cols: int = 20, required: Sequence[int] = (0,), refused: Sequence[str] = (), sep: str = "\t"
) -> DataFrame:
    """Data lines of a report under its section headers: ``file``, ``line_no``, ``section``, ``cells``.

    ``header`` is a pattern whose first group names the section. A header and the ``skip`` lines after it are no
    data; nor are lines before the first header, with fewer than ``min_cols`` cells, with a refused word as a cell,
    or with a blank required cell. ``lines`` has ``file``, ``line_no`` and ``text``. Lines are ordered in blocks of
    ``BLOCK_LINES``; the header that holds at a block's start comes from a table of one row a block.
    """
    found = F.nullif(F.regexp_extract("text", header, 1), F.lit(""))
    head = F.when(found.isNotNull(), F.struct(F.col("line_no").alias("at"), found.alias("name"))).alias("head")
    rows = lines.select("file", "line_no", "text", F.floor(F.col("line_no") / BLOCK_LINES).alias("block"), head)
    ends = rows.groupBy("file", "block").agg(F.max("head").alias("last"))
    before = F.max("last").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    w = Window.partitionBy("file", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    told = rows.withColumn("own", F.max("head").over(w)).join(ends.select("file", "block", before.alias("before")), ["file", "block"])
    now = F.coalesce("own", "before")
    told = told.select("file", "line_no", now["name"].alias("section"), now["at"].alias("_at"), F.transform(F.split("text", sep), lambda c: F.trim(c)).alias("cells"))
    keep = (F.col("line_no") > F.col("_at") + skip) & (F.size("cells") >= min_cols)
    for i in required:
        keep = keep & (F.coalesce(F.get("cells", F.lit(i)), F.lit("")) != "")
    if refused:
        keep = keep & ~F.arrays_overlap("cells", F.array(*[F.lit(r) for r in refused]))
    return told.where(keep).select("file", "line_no", "section", "cells")


def extract_block(cells: DataFrame, anchor: str, sub: str, offsets: Mapping[str, int], header_offset: int = 0, label_col: int = 0) -> DataFrame:
    """A tidy block of a sheet: the row of the first ``anchor``, below it the first ``sub``; rows at offsets from that
    give one column each, the header row the periods (first part of ``1T26 / 1Q26``). Columns without a period, or
    with no value, go. ``cells`` has ``sheet``, ``row``, ``col``, ``value``; a sheet without the anchor gives no rows.
    """
    label = F.trim("value")
    top = cells.where((F.col("col") == label_col) & (label == anchor)).groupBy("sheet").agg(F.min("row").alias("_top"))
    below = cells.join(top, "sheet").where((F.col("col") == label_col) & (label == sub) & (F.col("row") > F.col("_top")))
    start = below.groupBy("sheet").agg(F.min("row").alias("_sub"), F.first("_top").alias("_top"))
    block = cells.join(start, "sheet").where(F.col("col") > label_col)
    period = F.max(F.when(F.col("row") == F.col("_top") + header_offset, F.trim(F.split_part("value", F.lit("/"), F.lit(1))))).alias("period")
    picked = [F.max(F.when(F.col("row") == F.col("_sub") + o, F.trim("value"))).alias(n) for n, o in offsets.items()]
    out = block.groupBy("sheet", "col").agg(period, *picked).where(F.coalesce("period", F.lit("")) != "")
    return out.where(F.coalesce(*[F.col(n) for n in offsets]).isNotNull()).select("sheet", "col", "period", *offsets)


def clean_series_grid(df: DataFrame, line: str, date: str, flow: str, balance: str, numerics: Sequence[str], start: int, end: int | None = None) -> DataFrame:
    """Data rows of a series sheet: within the lines, under a date, not of a future month (flow 0, no balance);
    footers have no date. Numbers that can't be read are null."""
    day = F.coalesce(F.try_to_date(date, "dd/MM/yyyy"), F.try_to_date(date, "yyyy-MM-dd"))
    rows = df.where(F.col(line) >= start) if end is None else df.where(F.col(line).between(start, end))
    rows = rows.withColumn(date, day).where(F.col(date).isNotNull()).withColumns({c: F.col(c).try_cast("double") for c in numerics})
    return rows.where(~((F.coalesce(F.col(flow), F.lit(0.0)) == 0) & F.col(balance).isNull())).drop(line)

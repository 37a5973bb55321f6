"""Sources, loads, nested records, checks and file-listing comparison, on data derived from the star tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marajo.operators import checks as Q
from marajo.operators import loading as L
from marajo.operators import nested as N
from marajo.operators import stored as K
from marajo.operators import tables as T
from marajo.plans.kit import Kit
from marajo.session import checkpoint_root, stash
from marajo.sources import files as S
from marajo.streaming import incremental as I

kit = Kit()
QUERIES, ORACLES = kit.queries, kit.oracles


def _folder(t, name: str) -> str:
    return f"{checkpoint_root(t.spark).rstrip('/')}/marajo-{name}-{uuid.uuid4().hex}"


# --- scans, drops -------------------------------------------------------------------------------------------


@kit.query("l1_read_staging", "select n_nationkey, n_name from nation")
def _(t):
    root, _, source = t.sf_dir.rstrip("/").rpartition("/")
    return S.read_staging(t.spark, root, source, "nation").select("n_nationkey", "n_name")


@kit.query("l2_read_table", "select distinct o_orderpriority from orders where o_orderstatus is not null")
def _(t):
    t("orders").createOrReplaceTempView("marajo_orders")
    return S.read_table(t.spark, "marajo_orders").where("o_orderstatus is not null").select("o_orderpriority").distinct()


@kit.query("l3_to_staging", "select c_custkey, c_acctbal, cast(c_nationkey as varchar) as c_nationkey from customer")
def _(t):
    out = _folder(t, "staging")
    raw = t("customer").select(*[F.col(c).cast("string").alias(c) for c in ("c_custkey", "c_acctbal", "c_nationkey")])
    S.to_staging(raw, "frame", {"c_custkey": lambda c: c.cast("long"), "c_acctbal": lambda c: c.cast("double")}, out)
    return t.spark.read.parquet(out)


@kit.query("l4_delimited_drop", "select cast(p_partkey as varchar) as p_partkey, p_name || ' é' as p_name, cast(p_size as varchar) as p_size from part")
def _(t):
    root = _folder(t, "drop")
    rows = t("part").select("p_partkey", F.concat("p_name", F.lit(" é")).alias("P Name"), "p_size")
    for i, (sep, encoding) in enumerate([(";", "UTF-8"), (",", "ISO-8859-1"), ("|", "UTF-8"), ("\t", "ISO-8859-1")]):
        rows.where(F.col("p_partkey") % 4 == i).write.csv(f"{root}/{i}", header=True, sep=sep, encoding=encoding)
    return S.read_delimited_drop(t.spark, f"{root}/*/*.csv").select("p_partkey", "p_name", "p_size")


_QUOTED_NOTE = r"""p_name || chr(10) || '"' || p_brand || '";' || case when p_partkey % 3 = 0 then chr(10) || chr(10) else '' end || p_type"""


@kit.query("l4_quoted_drop", f"select cast(p_partkey as varchar) as p_partkey, {_QUOTED_NOTE} as note, cast(p_size as varchar) as p_size from part")
def _(t):
    root = _folder(t, "quoted")
    note = F.concat("p_name", F.lit('\n"'), "p_brand", F.lit('";'), F.when(F.col("p_partkey") % 3 == 0, "\n\n").otherwise(""), "p_type")
    t("part").select("p_partkey", note.alias("note"), "p_size").write.csv(root, header=True, sep=";", escape='"')
    before = t.spark.conf.get("spark.sql.files.maxPartitionBytes")
    t.spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")  # records cross splits
    try:
        return stash(S.read_delimited_drop(t.spark, f"{root}/*.csv").drop("source_path"), "quoted")
    finally:
        t.spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@kit.query("l5_normalize_columns", "select c_custkey as cust_key, c_name as nome, c_name as nome_1, c_nationkey as nation_key from customer")
def _(t):
    rows = t("customer").select("c_custkey", "c_name", "c_name", "c_acctbal", "c_nationkey").toDF("Cust--Key", "Nome ", "nome", "Unnamed: 3", "(Nation) Key")
    return L.normalize_columns(rows)


@kit.query("l6_read_positional", """
select cast(s_suppkey as varchar) as id, s_name as col_1, cast(s_nationkey as varchar) as nation from supplier""")
def _(t):
    lines = t("supplier").select(
        F.concat(F.lit("f"), F.col("s_nationkey").cast("string")).alias("file"), (F.col("s_suppkey") + 10).alias("line_no"),
        F.concat_ws("\t", F.col("s_suppkey").cast("string"), "s_name", F.col("s_nationkey").cast("string")).alias("text"),
    )
    noise = lines.select("file", F.lit(3).cast("long").alias("line_no"), F.lit("preamble").alias("text")).distinct()
    return S.positional(lines.unionByName(noise), {0: "id", 2: "nation"}, skiprows=5).select("id", "col_1", "nation")


@kit.query("l6_read_utf16", """
select cast(s_suppkey as varchar) as id, s_name as col_1, cast(s_nationkey as varchar) || ' é' as nation from supplier""")
def _(t):
    path = _folder(t, "utf16")
    rows = t("supplier").select(F.concat_ws("\t", F.col("s_suppkey").cast("string"), "s_name", F.concat(F.col("s_nationkey").cast("string"), F.lit(" é"))).alias("value"))
    # every file begins with a byte order mark and three lines that aren't data
    held = rows.groupBy((F.crc32("value") % 7).alias("f")).agg(F.concat(F.lit("\ufeffreport\r\n\r\nid\tname\tnation\r\n"), F.array_join(F.collect_list("value"), "\r\n")).alias("value"))
    held.select("f", F.encode("value", "UTF-16LE").cast("string").alias("value")).write.partitionBy("f").options(encoding="UTF-16LE", lineSep="\n").text(path)
    return S.read_positional(t.spark, f"{path}/*/*.txt", {0: "id", 2: "nation"}, skiprows=3)[["id", "col_1", "nation"]]


@kit.query("l7_union_batches", """
select c_custkey as k, c_name as name, null as extra, timestamp '2024-01-01' as dt_ingest from customer
union all select s_suppkey, s_name, 'x', timestamp '2024-01-01' from supplier""")
def _(t):
    a = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    b = t("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.lit("x").alias("extra"))
    return L.union_batches([a, a.limit(0), b], F.lit("2024-01-01").cast("timestamp"))


@kit.query("l8_sectioned_report", """
select cast(l_suppkey as varchar) as file, l_orderkey * 10 + l_linenumber as line_no, '2024' as section, cast(l_orderkey as varchar) as key
from lineitem where l_quantity > 25""")
def _(t):
    line = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_no")
    cells = F.concat_ws("\t", F.col("l_orderkey").cast("string"), *[F.lit(str(i)) for i in range(20)])
    text = F.when(F.col("l_quantity") > 25, cells).when(F.col("l_linenumber") % 2 == 0, "short\tline").otherwise(F.concat(F.lit("Total\t"), cells))
    data = t("lineitem").select(F.col("l_suppkey").cast("string").alias("file"), line, text.alias("text"))
    heads = data.select("file").distinct().select("file", F.lit(-10).cast("long").alias("line_no"), F.lit("Ano Lançamento: 2024").alias("text"))
    found = N.sectioned_report(data.unionByName(heads), r"Ano Lançamento: (\d{4})", skip=5, min_cols=20, required=(0, 1), refused=("Total",))
    return found.select("file", "line_no", "section", F.get("cells", F.lit(0)).alias("key"))


@kit.query("l9_flatten_nested", """
select event_id, cast(json_extract(props, '$.k') as bigint) as p__k, event_type as p__in__kind, '["' || event_type || '","x"]' as p__in__tags from events""")
def _(t):
    inner = F.struct(F.col("event_type").alias("kind"), F.array("event_type", F.lit("x")).alias("tags"))
    rows = t("events").select("event_id", F.struct(F.from_json("props", "k long").k.alias("k"), inner.alias("in")).alias("p"))
    return N.flatten_nested(rows)


@kit.query("l10_explode_series", """
select r_regionkey as variavel_id, r_name as variavel_nome, n_nationkey as localidade_id, n_name as localidade_nome,
  case when r_regionkey % 2 = 0 then '0' else 'c1|c2' end as classificacao_id, case when r_regionkey % 2 = 0 then '' else 'sexo|cor' end as classificacao_nome,
  case when r_regionkey % 2 = 0 then '0' else '7|8' end as categoria_id, case when r_regionkey % 2 = 0 then '' else 'a|b' end as categoria_nome,
  'un' as unidade, p as periodo, case when p = '202401' then cast(n_nationkey as varchar) end as valor
from region join nation on n_regionkey = r_regionkey, (values ('202401'), ('202402')) v(p)""")
def _(t):
    series = F.struct(
        F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("nome")).alias("localidade"),
        F.create_map(F.lit("202401"), F.col("n_nationkey").cast("string"), F.lit("202402"), F.lit("...")).alias("serie"),
    )
    category = lambda i, n, k, v: F.struct(F.lit(i).alias("id"), F.lit(n).alias("nome"), F.create_map(F.lit(k), F.lit(v)).alias("categoria"))
    some = F.array(category("c1", "sexo", "7", "a"), category("c2", "cor", "8", "b"))
    places = t("nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.collect_list(series).alias("series"))
    result = F.struct(F.when(F.col("r_regionkey") % 2 == 1, some).alias("classificacoes"), F.col("series").alias("series"))
    payload = t("region").join(places, "r_regionkey").select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("variavel"), F.lit("un").alias("unidade"), F.array(result).alias("resultados")
    )
    return N.explode_series_payload(payload)


@kit.query("l11_explode_date_map", """
select o_custkey, cast(o_orderdate as date) as date, max(o_totalprice) as close from orders where o_orderdate >= timestamp '1997-01-01' group by 1, 2""", dates="date")
def _(t):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    daily = t("orders").groupBy("o_custkey", day.alias("d")).agg(F.max("o_totalprice").alias("p"))
    packed = daily.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("d", F.struct(F.col("p").alias("4. close"))))).alias("days"))
    return N.explode_date_map(packed, "days", {"close": ("`4. close`", "double")}, ["o_custkey"], "1997-01-01")


@kit.query("l12_drop_header_record", "select n_regionkey, cast(n_nationkey as varchar) as code, n_name as name from nation")
def _(t):
    item = lambda a, b: F.create_map(F.lit("D1C"), a, F.lit("V"), b)
    rows = t("nation").groupBy("n_regionkey").agg(F.collect_list(item(F.col("n_nationkey").cast("string"), F.col("n_name"))).alias("rs"))
    rows = rows.select("n_regionkey", F.concat(F.array(item(F.lit("Código"), F.lit("Valor"))), "rs").alias("rs"))
    return N.drop_header_record(rows, "rs", {"D1C": "code", "V": "name"}, ["n_regionkey"])


def _xml_nations(t):
    """A document per region: its nations as elements, each with its suppliers as children (none for odd nations)."""
    child = F.concat(F.lit("<sup><ns2:key>"), F.col("s_suppkey").cast("string"), F.lit("</ns2:key></sup>"))
    suppliers = t("supplier").where("s_nationkey % 2 = 0").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.array_join(F.sort_array(F.collect_list(child)), "").alias("kids"))
    one = F.concat(
        F.lit("<ns1:nation id='1'><ns1:name> "), "n_name", F.lit(" </ns1:name><ns1:note>  </ns1:note><ns1:code>"), F.col("n_nationkey").cast("string"),
        F.lit("</ns1:code>"), F.coalesce("kids", F.lit("")), F.lit("</ns1:nation>"),
    )
    docs = t("nation").join(suppliers, "n_nationkey", "left").groupBy("n_regionkey").agg(F.array_join(F.collect_list(one), "\n").alias("body"))
    return docs.select("n_regionkey", F.concat(F.lit("<soap:Body xmlns:ns1='urn:a' xmlns:soap='urn:s'><list>"), "body", F.lit("</list><leave><name>gone</name><days>3</days></leave></soap:Body>")).alias("xml"))


@kit.query("l13_xml_rows", "select n_regionkey, n_name as name, cast(null as varchar) as note, cast(n_nationkey as varchar) as code from nation")
def _(t):
    return N.xml_rows(_xml_nations(t), "xml", "nation", ["name", "note", "code"], ["n_regionkey"])


@kit.query("l14_xml_parent_child", """
select n_name as name, cast(s_suppkey as varchar) as sup__key from nation left join (select * from supplier where s_nationkey % 2 = 0) on s_nationkey = n_nationkey""")
def _(t):
    return N.xml_parent_child(_xml_nations(t), "xml", "nation", ["name"], "sup", ["key"])


@kit.query("l15_xml_union_elements", """
select n_regionkey, n_name as name, null as days, 'nation' as element from nation union all select r_regionkey, 'gone', '3', 'leave' from region
where r_regionkey in (select n_regionkey from nation)""")
def _(t):
    return N.xml_union_elements(_xml_nations(t), "xml", {"nation": ["name"], "leave": ["name", "days"]}, ["n_regionkey"])


@kit.query("l16_extract_block", """
select cast(l_suppkey as varchar) as sheet, l_linenumber as col, cast(l_linenumber as varchar) || 'T26' as period,
  cast(cast(sum(l_quantity) as bigint) as varchar) as units, cast(count(*) as varchar) as n from lineitem group by 1, 2, 3""")
def _(t):
    sums = t("lineitem").groupBy(F.col("l_suppkey").cast("string").alias("sheet"), F.col("l_linenumber").alias("col")).agg(
        F.sum("l_quantity").cast("long").cast("string").alias("u"), F.count(F.lit(1)).cast("string").alias("n")
    )
    cell = lambda r, c, v: F.struct(F.lit(r).alias("row"), c.alias("col"), v.alias("value"))
    k = F.col("col").cast("string")
    header = F.concat(k, F.lit("T26 / "), k, F.lit("Q26"))
    body = sums.select("sheet", F.explode(F.array(cell(4, F.col("col"), header), cell(7, F.col("col"), F.col("u")), cell(8, F.col("col"), F.concat(F.lit(" "), "n")))).alias("c"))
    zero = F.lit(0)
    labels = sums.select("sheet").distinct().select(
        "sheet", F.explode(F.array(cell(4, zero, F.lit("Lançamentos")), cell(2, zero, F.lit("Total")), cell(6, zero, F.lit("Total")), cell(9, zero, F.lit("Lançamentos")))).alias("c")
    )
    return N.extract_block(body.unionByName(labels).select("sheet", "c.*"), "Lançamentos", "Total", {"units": 1, "n": 2})


@kit.query("l17_clean_series_grid", """
select cast(o_orderdate as date) as d, o_totalprice as flow, cast(o_custkey as double) as balance from orders where o_orderkey > 100 and o_orderkey % 5 < 3""", dates="d")
def _(t):
    m = F.col("o_orderkey") % 5
    rows = t("orders").select(
        F.col("o_orderkey").alias("line"),
        F.when(m == 3, "Fonte: banco").when(m == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("d"),
        F.when(m == 4, "0").otherwise(F.col("o_totalprice").cast("string")).alias("flow"),
        F.when(m != 4, F.col("o_custkey").cast("string")).alias("balance"),
    )
    return N.clean_series_grid(rows, "line", "d", "flow", "balance", ["flow", "balance"], 101)


# --- keyed loads --------------------------------------------------------------------------------------------


@kit.query("l18_upsert", """
select o_orderkey as k, o_totalprice as v, null as note from orders where o_orderkey % 3 > 0
union all select o_orderkey, o_totalprice + 2, 'new' from orders where o_orderkey % 3 = 0""")
def _(t):
    target = t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"), F.lit(0).alias("seq"))
    some = t("orders").where("o_orderkey % 3 = 0")
    batch = some.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"), F.explode(F.array(F.lit(1), F.lit(2))).alias("seq"))
    return L.upsert(target, batch.withColumn("v", F.col("v") + F.col("seq")).withColumn("note", F.lit("new")), ["k"], "seq").drop("seq")


@kit.query("l18_keyed_store", """
select o_orderkey as k, case when o_orderkey % 5 = 0 then o_totalprice + 7 when o_orderkey % 3 = 0 then o_totalprice + 2 else o_totalprice end as v,
  case when o_orderkey % 5 = 0 then 'third' end as note from orders where o_orderkey % 2 = 0 or o_orderkey % 3 = 0 or o_orderkey % 5 = 0""")
def _(t):
    path = _folder(t, "keyed")
    rows = lambda rule, more: t("orders").where(rule).select(F.col("o_orderkey").alias("k"), (F.col("o_totalprice") + more).alias("v"), F.lit(more).alias("seq"))
    twice = rows("o_orderkey % 3 = 0", 1).unionByName(rows("o_orderkey % 3 = 0", 2))
    for batch in (rows("o_orderkey % 2 = 0", 0), twice, rows("o_orderkey % 5 = 0", 7).withColumn("note", F.lit("third"))):
        K.upsert_into(path, batch, ["k"], "seq", 16)
    return K.read_stored(t.spark, path).drop("seq")


@kit.query("l20_append_store", """
select o_custkey, o_orderpriority, coalesce(min(o_orderkey) filter (o_orderkey % 2 = 0), min(o_orderkey)) as o_orderkey from orders group by 1, 2""")
def _(t):
    path = _folder(t, "append")
    rows = t("orders").select("o_custkey", "o_orderpriority", "o_orderkey")
    for half in (0, 1):
        K.append_into(path, rows.where(F.col("o_orderkey") % 2 == half), ["o_custkey", "o_orderpriority"], "o_orderkey", 16)
    return K.read_stored(t.spark, path)


@kit.query("l19_full_refresh", "select r_regionkey, r_name from region")
def _(t):
    path = _folder(t, "refresh")
    for rows in (t("region").limit(1), t("region")):
        L.full_refresh(rows, path)
    return t.spark.read.parquet(path)


@kit.query("l20_dedupe_keep_first", """
select o_custkey, o_orderpriority, min(o_orderkey) as o_orderkey from orders group by 1, 2""")
def _(t):
    return L.dedupe_keep_first(t("orders").select("o_custkey", "o_orderpriority", "o_orderkey"), ["o_custkey", "o_orderpriority"], "o_orderkey")


@kit.query("l21_evolve_schema", """
select n_nationkey as k, n_name as name, null as size from nation union all select p_partkey, null, p_size from part""")
def _(t):
    return L.evolve_schema(t("nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")), t("part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("size")))


@kit.query("l22_dedupe_batch", """
with o as (select o_orderkey, o_custkey, coalesce(case when o_orderkey % 5 > 0 then o_orderpriority end, 'Sem Partido') as party from orders)
select o_custkey, party, min(o_orderkey) as first_seen, max(o_orderkey) as last_seen from o group by 1, 2""")
def _(t):
    rows = t("orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderpriority")).alias("party"))
    pick = lambda keep, name: L.dedupe_batch(rows, ["o_custkey", "party"], "o_orderkey", keep, {"party": "Sem Partido"}).withColumnRenamed("o_orderkey", name)
    return pick("first", "first_seen").join(pick("last", "last_seen"), ["o_custkey", "party"])


@kit.query("l23_gate_rows", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as d from orders where year(o_orderdate) >= 2000")
def _(t):
    return T.gate_rows(t("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d")), "d", "20")


@kit.query("l24_incremental_files", """
select cast(c_custkey as varchar) as c_custkey, c_mktsegment from customer""")
def _(t):
    root, out = _folder(t, "share"), _folder(t, "loaded")
    rows = t("customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_mktsegment")
    rows.where("c_custkey % 2 = 0").write.csv(f"{root}/in", header=True, sep=";")

    def sink(batch, number):
        batch.select("c_custkey", "c_mktsegment").write.mode("overwrite").parquet(f"{out}/batch={number}")

    load = lambda: I.stream_drop(t.spark, f"{root}/in", "c_custkey string, c_mktsegment string", f"{root}/check", sink)
    load()
    rows.where("c_custkey % 2 = 1").write.mode("append").csv(f"{root}/in", header=True, sep=";")
    load()
    load()
    return t.spark.read.parquet(out).select("c_custkey", "c_mktsegment")


@kit.query("l24_ledger", """
select 'd/' || p_brand || '/' || cast(p_partkey as varchar) || '.csv' as path from part where p_size % 2 = 0""")
def _(t):
    path = F.concat(F.lit("d/"), "p_brand", F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".csv")).alias("path")
    files = t("part").select(path, F.col("p_size").alias("size"))
    done = files.where("size % 2 = 1")
    ledger = I.ledger_rows(done, F.col("size")).unionByName(I.ledger_rows(done, F.col("size")))
    return I.incremental_files(files, ledger).select("path")


@kit.query("l25_table_names", """
with f as (select p_partkey, 'base_' || lower(replace(p_brand, '#', '_')) as base from part)
select p_partkey, base || case when rn = 1 then '' else '_' || lpad(cast(rn - 1 as varchar), 4, '0') end as table_name
from (select *, row_number() over (partition by base order by p_partkey) as rn from f)""")
def _(t):
    files = t("part").select("p_partkey", F.concat(F.lit("Base/"), "p_brand", F.lit(".csv")).alias("path"), F.col("p_partkey").alias("processed_at"))
    return L.table_names(files).select("p_partkey", "table_name")


@kit.query("l26_replicate_tables", "select 'nation' as tbl, n_nationkey as k, n_name as name from nation union all select 'region', r_regionkey, r_name from region")
def _(t):
    read = {
        "nation": t("nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.lit(1).alias("seq")),
        "region": t("region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"), F.lit(1).alias("seq")),
    }
    old = {name: frame.where("k < 2").withColumns({"name": F.lit("old"), "seq": F.lit(0)}) for name, frame in read.items()}
    made = S.replicate_tables(t.spark, {"nation": ["k"], "region": ["k"]}, read.get, old.get, "seq")
    return L.union_batches([frame.select(F.lit(name).alias("tbl"), "k", "name") for name, frame in made.items()])


@kit.query("l27_stamp", "select r_regionkey, cast(null as timestamp) as dt_ingest, timestamp '2024-05-01' as dt_silver, timestamp '2024-05-02' as dt_gold from region")
def _(t):
    at = lambda d: F.lit(d).cast("timestamp")
    silver = L.stamp(t("region").select("r_regionkey"), "silver", has_ingest_date=False, at=at("2024-05-01"))
    return L.stamp(silver, "gold", at=at("2024-05-02"))


@kit.query("l28_report_document", r"""
with top as (select * from customer order by c_acctbal desc, c_custkey limit 100)
select '{"kpis":{"total":' || (select count(*) from customer) || ',"highest":' || (select max(c_acctbal) from customer) || '},"states":{'
  || (select string_agg('"' || k || '":' || n, ',' order by k) from (select cast(c_nationkey as varchar) as k, count(*) as n from customer group by 1))
  || '},"segments":[' || (select string_agg('{"c_mktsegment":"' || c_mktsegment || '","n":' || n || '}', ',' order by c_mktsegment) from (select c_mktsegment, count(*) as n from customer group by 1))
  || '],"top":[' || (select string_agg('{"c_custkey":' || c_custkey || ',"c_acctbal":' || c_acctbal || '}', ',' order by c_acctbal desc, c_custkey) from top) || ']}' as document""")
def _(t):
    by = lambda c: t("customer").groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    frames = {
        "kpis": t("customer").agg(F.count(F.lit(1)).alias("total"), F.max("c_acctbal").alias("highest")),
        "states": by("c_nationkey"),
        "segments": by("c_mktsegment").orderBy("c_mktsegment"),
        "top": T.top_n(t("customer").select("c_custkey", "c_acctbal"), "c_acctbal", 100, ["c_custkey"]),
    }
    order = {"segments": ["c_mktsegment"], "top": [-F.col("c_acctbal"), "c_custkey"]}
    return S.report_document(frames, {"states": ("c_nationkey", "n")}, {"kpis": {"total": 0, "highest": 0.0}}, order)


@kit.query("l29_half_year_windows", """
with w as (select cast(greatest(b, date '1996-03-15') as date) as begins, cast(least(b + interval 6 months, date '1998-02-01') as date) as ends
  from (select unnest(generate_series(timestamp '1996-01-01', timestamp '1998-01-01', interval 6 months)) as b))
select begins, ends, count(o_orderkey) as n from w left join orders on o_orderdate >= begins and o_orderdate < ends group by 1, 2""", dates="begins ends")
def _(t):
    windows = L.half_year_windows(t.spark, "1996-03-15", "1998-02-01")
    orders = L.assign_half_year(t("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "1996-03-15", "1998-02-01")
    n = orders.groupBy(F.col("window_begins").alias("begins")).agg(F.count("o_orderkey").alias("n"))
    return windows.join(n, "begins", "left").select("begins", "ends", F.coalesce("n", F.lit(0)).alias("n"))


@kit.query("l31_surrogate_id", """
select event_id, cast(user_id as varchar) || '_' || cast(row_number() over (partition by user_id order by event_id) - 1 as varchar)
  || case when event_type = 'view' then '_' || event_type else '' end as record_id from events""")
def _(t):
    rows = t("events").select("event_id", "user_id", F.when(F.col("event_type") == "view", F.col("event_type")).alias("child"))
    return L.surrogate_id(rows, "user_id", ["child"], "event_id").select("event_id", "record_id")


@kit.query("l32_project_nested", "select event_id as id, event_type as kind, user_id as who from events")
def _(t):
    rows = t("events").select(F.struct(F.col("event_id").alias("id"), F.struct("event_type", "user_id").alias("b")).alias("a"))
    return N.project_nested(rows, {"id": "a.id", "kind": "a.b.event_type", "who": "a.b.user_id"})


@kit.query("load_configs", """
select 'upsert' as mode, count(*) as n from orders union all select 'append_dedupe', count(distinct o_custkey) from orders
union all select 'refresh', count(*) from orders where year(o_orderdate) >= 2000""")
def _(t):
    rows = t("orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy").alias("year"), F.col("o_orderdate").alias("dt_ingest"))
    half = rows.where("o_orderkey % 2 = 0")
    runs = {
        "upsert": L.LoadConfig("orders", ("o_orderkey",)),
        "append_dedupe": L.LoadConfig("notes", ("o_custkey",), "append_dedupe"),
        "refresh": L.LoadConfig("view", mode="refresh", gate=("year", "20")),
    }
    root, found = _folder(t, "loads"), []
    for mode, config in runs.items():
        for batch in (half, rows):
            K.load_into(config, f"{root}/{mode}", batch, partitions=16)
        found.append(K.read_stored(t.spark, f"{root}/{mode}").agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n")))
    return L.union_batches(found)


# --- checks -------------------------------------------------------------------------------------------------


@kit.query("q1_row_count", "select (select count(*) from orders) as source_rows, (select count(*) from customer) as target_rows")
def _(t):
    return Q.check_row_count(t("orders"), t("customer")).unionByName(Q.check_row_count(t("orders"), t("orders")))


@kit.query("q2_types", "select 'o_custkey' as column_name, 'string' as expected_type, 'bigint' as actual_type union all select 'o_none', 'int', null")
def _(t):
    return Q.check_types(t("orders"), {"o_orderkey": "bigint", "o_custkey": "string", "o_none": "int"})


@kit.query("q3_not_null_unique", """
select 'null' as kind, o_custkey as k, count(*) as n from orders where o_orderstatus = 'P' group by 2
union all select 'repeated', o_custkey, count(*) from orders group by 2 having count(*) > 1""")
def _(t):
    rows = t("orders").select("o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("s"))
    nulls = Q.check_not_null(rows, "s").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    repeated = Q.check_unique(rows, "o_custkey").withColumnRenamed("o_custkey", "k")
    return nulls.select(F.lit("null").alias("kind"), "k", "n").unionByName(repeated.select(F.lit("repeated").alias("kind"), "k", "n"))


@kit.query("q4_model_metadata", """
select 'gold' as schema_name, n_name as table_name, timestamp '2024-02-01' as executed_at, cast(n_nationkey as bigint) as n_rows from nation where n_nationkey % 2 = 0
union all select 'gold', n_name, timestamp '2024-01-01', null from nation where n_nationkey % 2 = 1""")
def _(t):
    rows = lambda d: t("nation").select(F.lit("gold").alias("schema_name"), F.col("n_name").alias("table_name"), F.lit(d).cast("timestamp").alias("executed_at"), F.col("n_nationkey").cast("long").alias("n_rows"))
    return Q.record_model_metadata(rows("2024-01-01").drop("n_rows"), rows("2024-02-01").where("n_rows % 2 = 0"))


def _listings(t):
    """Two listings of a share: from the old one files move, are copied, change, go and come, by key."""
    k = F.col("p_partkey")
    name = F.concat(F.lit("f"), (k % 50).cast("string"), F.lit(".csv"))
    old = t("part").select(k.alias("k"), F.concat(F.lit("in/"), k.cast("string"), F.lit("/"), name).alias("path"), F.col("p_size").cast("long").alias("size"), k.alias("mtime"))
    m = k % 7
    new = t("part").select(
        k.alias("k"), F.concat(F.when(m == 0, "old/").otherwise("in/"), k.cast("string"), F.lit("/"), name).alias("path"),
        (F.col("p_size") + F.when(m == 1, 1).otherwise(0)).cast("long").alias("size"), (k + F.when(m == 2, 1).otherwise(0)).alias("mtime"),
    )
    extra = t("part").where("p_partkey % 7 = 4").select(k.alias("k"), F.concat(F.lit("bak/"), k.cast("string"), F.lit("/"), name).alias("path"), F.col("p_size").cast("long").alias("size"), k.alias("mtime"))
    return old.drop("k"), new.where("k % 7 <> 3").drop("k").unionByName(extra.drop("k"))


_LISTINGS = """
o as (select 'in/' || p_partkey || '/f' || (p_partkey % 50) || '.csv' as path, cast(p_size as bigint) as size, p_partkey as mtime from part),
n as (select case when p_partkey % 7 = 0 then 'old/' else 'in/' end || p_partkey || '/f' || (p_partkey % 50) || '.csv' as path,
    cast(p_size + case when p_partkey % 7 = 1 then 1 else 0 end as bigint) as size, p_partkey + case when p_partkey % 7 = 2 then 1 else 0 end as mtime from part where p_partkey % 7 <> 3
  union all select 'bak/' || p_partkey || '/f' || (p_partkey % 50) || '.csv', p_size, p_partkey from part where p_partkey % 7 = 4),
d as (select coalesce(o.path, n.path) as path, case when o.path is null then 'added' when n.path is null then 'removed'
    when o.size <> n.size or o.mtime <> n.mtime then 'modified' else 'unchanged' end as status, o.size as old_size, n.size as new_size,
    o.mtime as old_mtime, n.mtime as new_mtime, split_part(coalesce(o.path, n.path), '/', 3) as name from o full join n on o.path = n.path),
a as (select *, row_number() over (partition by name, new_size order by path) as i from d where status = 'added'),
r as (select *, row_number() over (partition by name, old_size order by path) as i from d where status = 'removed'),
moves as (select r.path as from_path, a.path as to_path, a.new_size as size from a join r on a.name = r.name and a.new_size = r.old_size and a.i = r.i),
copies as (select min(s.path) as from_path, a.path as to_path, a.new_size as size from a join d s on s.name = a.name and s.new_size = a.new_size and s.status in ('modified', 'unchanged')
  where a.path not in (select to_path from moves) group by 2, 3)"""


@kit.query("q5_diff_snapshots", f"with {_LISTINGS} select path, status, old_size, new_size, old_mtime, new_mtime from d")
def _(t):
    return Q.diff_snapshots(*_listings(t))


@kit.query("q6_detect_moves", f"with {_LISTINGS} select * from moves")
def _(t):
    return Q.detect_moves(Q.diff_snapshots(*_listings(t)))


@kit.query("q7_detect_copies", f"with {_LISTINGS} select * from copies")
def _(t):
    return Q.detect_copies(Q.diff_snapshots(*_listings(t)))


@kit.query("q8_summarize_changes", f"""
with {_LISTINGS}, c as (select (select count(*) from d where status = 'modified') as modified, (select count(*) from moves) as moved, (select count(*) from copies) as copied,
  (select count(*) from d where status = 'added') - (select count(*) from moves) - (select count(*) from copies) as added,
  (select count(*) from d where status = 'removed') - (select count(*) from moves) as removed, (select count(*) from d where status = 'unchanged') as unchanged)
select *, concat_ws(', ', case when modified > 0 then 'overwrite' end, case when moved > 0 then 'archive by move' end, case when copied > 0 then 'archive by copy' end,
  case when added > 0 and modified = 0 and moved = 0 then 'append' end, case when removed > 0 then 'delete' end) as pattern from c""")
def _(t):
    return Q.summarize_changes(Q.diff_snapshots(*_listings(t)))


@kit.query("q9_comparison_key", """
select p_partkey, 'a/' || p_partkey || '.csv' as by_path, p_partkey || '.csv' as by_name from part""")
def _(t):
    k = F.col("p_partkey").cast("string")
    path = F.concat(F.when(F.col("p_partkey") % 2 == 0, "./").otherwise("//"), F.lit("a/"), k, F.lit(".csv"))
    return t("part").select("p_partkey", Q.comparison_key(path).alias("by_path"), Q.comparison_key(path, "filename").alias("by_name"))

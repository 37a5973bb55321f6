"""Cleaning functions and predicates over text derived from clean columns; the SQL gives the clean values."""

from __future__ import annotations

from pyspark.sql import functions as F

from marajo.functions import cleaning as C
from marajo.operators import tables as T
from marajo.plans.kit import Kit

kit = Kit()
QUERIES, ORACLES = kit.queries, kit.oracles


def _money(c):
    """A number as Brazilian text, ``1.234,56``."""
    return F.translate(F.format_number(c, 2), ",.", ".,")


@kit.query("c1_parse_financial", """
select o_orderkey, case when o_orderkey % 6 >= 4 then 0.0 else round(o_totalprice, 2) end as amount from orders""")
def _(t):
    plain = F.format_string("%.2f", "o_totalprice")
    comma = F.replace(plain, F.lit("."), F.lit(","))
    m = F.col("o_orderkey") % 6
    text = (
        F.when(m == 0, _money("o_totalprice")).when(m == 1, comma).when(m == 2, F.lpad(comma, 16, "0")).when(m == 3, plain).when(m == 4, "None").otherwise("NaN")
    )
    return t("orders").select("o_orderkey", C.parse_financial(text).cast("double").alias("amount"))


@kit.query("c2_parse_int", """
select p_partkey, case when p_partkey % 4 in (0, 1) then p_size end as size from part""")
def _(t):
    m = F.col("p_partkey") % 4
    text = F.when(m == 0, F.concat(F.lit(" "), "p_size", F.lit(" "))).when(m == 1, F.col("p_size").cast("string")).when(m == 2, "None").otherwise("  ")
    return t("part").select("p_partkey", C.parse_int(text).alias("size"))


@kit.query("c3_parse_numeric", """
select s_suppkey, case when s_suppkey % 3 = 2 then null else round(s_acctbal, 2) end as balance from supplier""")
def _(t):
    plain = F.format_string("%.2f", "s_acctbal")
    m = F.col("s_suppkey") % 3
    text = F.when(m == 0, F.replace(plain, F.lit("."), F.lit(","))).when(m == 1, plain).otherwise("None")
    return t("supplier").select("s_suppkey", C.parse_numeric(text, "decimal(15,2)").cast("double").alias("balance"))


@kit.query("c4_num_br", """
select c_custkey, case when c_custkey % 5 < 3 then round(c_acctbal, 2) end as balance from customer""")
def _(t):
    m = F.col("c_custkey") % 5
    text = F.when(m < 3, _money("c_acctbal")).when(m == 3, "-").otherwise("n/d")
    return t("customer").select("c_custkey", C.num_br(text).alias("balance"))


@kit.query("c5_null_sentinels", """
select p_partkey, case when p_size % 4 = 3 then cast(p_size as varchar) end as size from part""")
def _(t):
    m = F.col("p_size") % 4
    text = F.when(m == 0, "-").when(m == 1, "..").when(m == 2, "...").otherwise(F.col("p_size").cast("string"))
    return t("part").select("p_partkey", C.null_sentinels(text).alias("size"))


@kit.query("c6_parse_date_br", """
select o_orderkey, case when o_orderkey % 5 < 3 then cast(o_orderdate as date) end as day from orders""", dates="day")
def _(t):
    m, d = F.col("o_orderkey") % 5, F.col("o_orderdate")
    text = (
        F.when(m == 0, F.date_format(d, "dd/MM/yyyy")).when(m == 1, F.date_format(d, "yyyyMMdd")).when(m == 2, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(m == 3, "31/02/2020").otherwise("sem data")
    )
    return t("orders").select("o_orderkey", C.parse_date_br(text).alias("day"))


@kit.query("c7_parse_date_ddmmyyyy", """
select o_orderkey, case when o_orderkey % 2 = 0 then cast(o_orderdate as date) end as day from orders""", dates="day")
def _(t):
    d = F.date_format("o_orderdate", "ddMMyyyy")
    return t("orders").select("o_orderkey", C.parse_date_ddmmyyyy(F.when(F.col("o_orderkey") % 2 == 0, d).otherwise("00000000")).alias("day"))


@kit.query("c8_period_to_date", """
select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as a, cast(date_trunc('month', o_orderdate) as date) as b,
  cast(date_trunc('month', o_orderdate) as date) as c, cast(null as date) as bad from orders""", dates="a b c bad")
def _(t):
    f = lambda p: F.date_format("o_orderdate", p)
    return t("orders").select(
        "o_orderkey", C.period_to_date(f("yyyyMM")).alias("a"), C.period_to_date(F.concat(f("yyyyMM"), F.lit("01")), "yyyymm01").alias("b"),
        C.period_to_date(f("MM/yyyy"), "mm/yyyy").alias("c"), C.period_to_date(F.lit("202513")).alias("bad"),
    )


@kit.query("c9_quarter_month_start", """
select o_orderkey, cast(date_trunc('quarter', o_orderdate) as date) as quarter_day, cast(date_trunc('month', o_orderdate) as date) as month_day
from orders""", dates="quarter_day month_day")
def _(t):
    d = F.col("o_orderdate")
    label = F.concat(F.quarter(d).cast("string"), F.lit("T"), F.year(d).cast("string"))
    return t("orders").select("o_orderkey", C.quarter_start(F.year(d), label).alias("quarter_day"), C.month_start(F.year(d), F.month(d)).alias("month_day"))


@kit.query("c10_period_parts", """
select o_orderkey, cast(quarter(o_orderdate) as int) as q, cast(year(o_orderdate) as int) as y, cast(month(o_orderdate) as int) as m from orders""")
def _(t):
    p = F.date_format("o_orderdate", "yyyyMM")
    return t("orders").select("o_orderkey", C.quarter_of(C.month_of_period(p)).alias("q"), C.year_of_period(p).alias("y"), C.month_of_period(p).alias("m"))


@kit.query("c11_normalize_key", """
select o_orderkey, case when o_orderkey % 4 = 3 then null else lpad(cast(o_orderkey as varchar), 8, '0') end as k,
  case when o_orderkey % 4 = 0 then left('0' || lpad(cast(o_orderkey as varchar), 8, '0'), 8)
       when o_orderkey % 4 = 3 then null else lpad(cast(o_orderkey as varchar), 8, '0') end as k_compat
from orders""")
def _(t):
    eight = F.lpad(F.col("o_orderkey").cast("string"), 8, "0")
    m = F.col("o_orderkey") % 4
    dashed = F.concat(F.lit("0"), F.left(eight, F.lit(6)), F.lit("-"), F.right(eight, F.lit(2)))
    text = F.when(m == 0, dashed).when(m == 1, F.concat(F.lit("00"), eight)).when(m == 2, F.col("o_orderkey").cast("string")).otherwise(" ")
    return t("orders").select("o_orderkey", C.normalize_key(text).alias("k"), C.normalize_key(text, compat=True).alias("k_compat"))


@kit.query("c12_tax_ids", r"""
select c_custkey, cast(c_custkey * 7919 as varchar) as d, lpad(cast(c_custkey * 7919 as varchar), 14, '0') as padded,
  regexp_replace(lpad(cast(c_custkey * 7919 as varchar), 14, '0'), '^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$', '\1.\2.\3/\4-\5') as masked from customer""")
def _(t):
    text = F.concat(F.lit(" /"), (F.col("c_custkey") * 7919).cast("string"), F.lit("-"))
    return t("customer").select("c_custkey", C.digits(text).alias("d"), C.pad_cnpj(text).alias("padded"), C.format_cnpj(text).alias("masked"))


@kit.query("c13_clean_text", """
select n_nationkey, case when n_nationkey % 3 = 0 then n_name end as a, case when n_nationkey % 3 = 0 then n_name when n_nationkey % 3 = 2 then 'None' end as b
from nation""")
def _(t):
    m = F.col("n_nationkey") % 3
    text = F.when(m == 0, F.concat(F.lit("  "), "n_name", F.lit(" "))).when(m == 1, "   ").otherwise(" None ")
    return t("nation").select("n_nationkey", C.clean_text(text, none=True).alias("a"), C.clean_text(text).alias("b"))


@kit.query("c14_flag_s", """
select o_orderkey, o_orderstatus = 'F' as flag from orders""")
def _(t):
    text = F.when(F.col("o_orderstatus") == "F", " S ").when(F.col("o_orderstatus") == "O", "N")
    return t("orders").select("o_orderkey", C.flag_s(text).alias("flag"))


@kit.query("c15_upper_trim", "select c_custkey, upper(c_mktsegment) as segment from customer")
def _(t):
    return t("customer").select("c_custkey", C.upper_trim(F.concat(F.lit("  "), F.initcap("c_mktsegment"), F.lit(" "))).alias("segment"))


@kit.query("c16_sentinels", """
select o_orderkey, case when o_orderkey % 2 = 0 then null else cast(o_orderdate as date) end as day,
  case when o_orderkey % 2 = 1 then round(-15 - 30 / 60.0 - (o_orderkey % 60) / 3600.0, 8) end as lat from orders""", dates="day")
def _(t):
    odd = F.col("o_orderkey") % 2 == 1
    day = F.when(odd, F.to_date("o_orderdate")).otherwise(F.lit("1900-01-01").cast("date"))
    lat = C.null_dms(F.when(odd, -15).otherwise(0), F.when(odd, 30).otherwise(0), F.when(odd, F.col("o_orderkey") % 60).otherwise(0))
    return t("orders").select("o_orderkey", C.null_date_sentinel(day).alias("day"), F.round(lat, 8).alias("lat"))


@kit.query("c17_decode", """
select o_orderkey, case o_orderstatus when 'F' then 'CONCLUÍDO' when 'O' then 'EM ANDAMENTO' else 'OUTRO (' || o_orderstatus || ')' end as status from orders""")
def _(t):
    return t("orders").select("o_orderkey", C.decode("o_orderstatus", {"F": "CONCLUÍDO", "O": "EM ANDAMENTO"}).alias("status"))


@kit.query("c18_bucket", """
select s_suppkey, case when s_nationkey in (1, 2, 3) then 'A' when s_nationkey in (4, 5) then 'B' else 'DEMAIS' end as grp from supplier""")
def _(t):
    nation = F.col("s_nationkey").cast("string")
    return t("supplier").select("s_suppkey", C.bucket(nation, {"A": ["1", "2", "3"], "B": ["4", "5"]}, "DEMAIS").alias("grp"))


@kit.query("c19_coalesce", """
select p_partkey, coalesce(case when p_size > 25 then p_name end, case when p_size > 10 then p_brand end, p_type) as label from part""")
def _(t):
    return t("part").select("p_partkey", F.coalesce(F.when(F.col("p_size") > 25, F.col("p_name")), F.when(F.col("p_size") > 10, F.col("p_brand")), F.col("p_type")).alias("label"))


@kit.query("c20_labels", """
select c_custkey, cast(c_custkey as varchar) || ' - ' || n_name || '/' || r_name || ' - ' || upper(c_name) as label, 'BR-' || left(n_name, 2) as iso
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def _(t):
    star = T.enrich(
        t("customer"), [(t("nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey"), (t("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")]
    )
    return star.select("c_custkey", C.search_label("c_custkey", "n_name", "r_name", "c_name").alias("label"), C.iso_state(F.left("n_name", F.lit(2))).alias("iso"))


@kit.query("c21_date_labels", """
select o_orderkey, strftime(o_orderdate, '%Y-%m') as year_month, strftime(o_orderdate, '%m/%Y') as month_year,
  strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') as year, strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') as quarter from orders""")
def _(t):
    return t("orders").select("o_orderkey", *[c.alias(n) for n, c in C.date_labels("o_orderdate").items()])


@kit.query("c22_days_between", """
select l_orderkey, l_linenumber, cast(case when l_linenumber = 1 then null else date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) end as int) as days
from lineitem join orders on l_orderkey = o_orderkey""")
def _(t):
    both = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    end = F.when(F.col("l_linenumber") == 1, F.lit("1900-01-01").cast("date")).otherwise(F.to_date("l_shipdate"))
    return both.select("l_orderkey", "l_linenumber", C.days_between(end, "o_orderdate").alias("days"))


@kit.query("c23_safe_ratio", """
select l_orderkey, l_linenumber, case when l_quantity - 10 > 0 then round(l_extendedprice / (l_quantity - 10) * 100, 2) else 0.0 end as ratio from lineitem""")
def _(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", C.safe_ratio("l_extendedprice", F.col("l_quantity") - 10, 100, digits=2).alias("ratio"))


@kit.query("c24_scale_round", """
select o_orderkey, cast(round(cast(o_totalprice as decimal(38, 6)) / 1000, 1) as double) as thousands, cast(floor(o_totalprice * 3.3) as bigint) as people from orders""")
def _(t):
    return t("orders").select("o_orderkey", C.scale_round("o_totalprice", 1e3).alias("thousands"), C.scaled_floor("o_totalprice").alias("people"))


@kit.query("c25_sum_components", """
select l_orderkey, l_linenumber, l_quantity + coalesce(case when l_linenumber > 2 then l_discount end, 0) + l_tax as total from lineitem""")
def _(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", C.sum_components("l_quantity", F.when(F.col("l_linenumber") > 2, F.col("l_discount")), "l_tax").alias("total"))


@kit.query("c26_local_run_time", """
select event_id, ts - interval 3 hours as local_ts from events""")
def _(t):
    return t("events").select("event_id", C.local_run_time("ts").alias("local_ts"))


@kit.query("l30_split_codes", """
select o_orderkey, lpad(cast(o_custkey as varchar), 14, '0') as cnpj, cast(o_orderkey as int) as seq, cast(year(o_orderdate) as int) as y,
  cast(year(o_orderdate) as varchar) as note_year, lpad(cast(o_orderkey % 1000000 as varchar), 6, '0') as note_number from orders""")
def _(t):
    year = F.year("o_orderdate").cast("string")
    control = F.concat(F.lpad(F.col("o_custkey").cast("string"), 14, "0"), F.lit("-1-"), F.col("o_orderkey").cast("string"), F.lit("/"), year)
    note = F.concat(year, F.lit("NC"), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0"))
    rows = t("orders").select("o_orderkey", C.split_control_number(control).alias("c"), C.split_note_number(note).alias("n"))
    return rows.select("o_orderkey", "c.cnpj", F.col("c.sequence").alias("seq"), F.col("c.year").alias("y"), F.col("n.year").alias("note_year"), F.col("n.number").alias("note_number"))


# --- predicates ---------------------------------------------------------------------------------------------


@kit.query("f1_in_list", "select o_orderkey, o_orderstatus from orders where o_orderstatus in ('F', 'P') and o_orderpriority = '1-URGENT'")
def _(t):
    return t("orders").where(F.col("o_orderstatus").isin("F", "P") & (F.col("o_orderpriority") == "1-URGENT")).select("o_orderkey", "o_orderstatus")


@kit.query("f2_between", "select o_orderkey, o_totalprice from orders where o_orderdate between timestamp '1996-01-01' and timestamp '1996-12-31'")
def _(t):
    return t("orders").where(F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp"), F.lit("1996-12-31").cast("timestamp"))).select("o_orderkey", "o_totalprice")


@kit.query("f3_require_any", """
select p_partkey, case when p_size > 40 then p_size end as a, case when p_retailprice > 1500 then p_retailprice end as b from part where p_size > 40 or p_retailprice > 1500""")
def _(t):
    rows = t("part").select("p_partkey", F.when(F.col("p_size") > 40, F.col("p_size")).alias("a"), F.when(F.col("p_retailprice") > 1500, F.col("p_retailprice")).alias("b"))
    return T.require_any(rows, ["a", "b"])


@kit.query("f4_fiscal_window", """
select o_orderkey from orders where (year(o_orderdate) = 1996 and quarter(o_orderdate) in (2, 3, 4)) or (year(o_orderdate) = 1997 and quarter(o_orderdate) = 1)""")
def _(t):
    rows = t("orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"))
    return rows.where(T.last_quarters("y", "q", 1997, 1)).select("o_orderkey")


@kit.query("f5_quarter_end_months", "select o_orderkey, cast(month(o_orderdate) as int) as m from orders where month(o_orderdate) in (3, 6, 9, 12)")
def _(t):
    return T.quarter_end_months(t("orders").select("o_orderkey", F.month("o_orderdate").alias("m")), "m")


@kit.query("f6_layout_class", """
select layout, count(*) as n from (select case o_orderkey % 3 when 0 then 'br' when 1 then 'compact' else 'other' end as layout from orders) group by layout""")
def _(t):
    m = F.col("o_orderkey") % 3
    text = F.when(m == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).when(m == 1, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.col("o_orderpriority"))
    layout = F.when(text.rlike(r"^\d{2}/\d{2}/\d{4}$"), "br").when(text.rlike(r"^\d{8}$"), "compact").otherwise("other")
    return t("orders").select(layout.alias("layout")).groupBy("layout").agg(F.count(F.lit(1)).alias("n"))


@kit.query("f7_credits_absolute", "select c_custkey, abs(c_acctbal) as amount from customer where c_mktsegment = 'BUILDING'")
def _(t):
    rows = t("customer").select("c_custkey", F.col("c_acctbal").alias("amount"), "c_mktsegment")
    return T.credits_absolute(rows, "c_mktsegment", ["amount"], "BUILDING").select("c_custkey", "amount")


@kit.query("udf_sql_functions", """
select o_orderkey, cast(o_orderdate as date) as day, lpad(cast(o_orderkey as varchar), 8, '0') as k from orders""", dates="day")
def _(t):
    C.register_sql_functions(t.spark)
    rows = t("orders").select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("d"), F.concat(F.lit("-"), F.col("o_orderkey").cast("string")).alias("x"))
    return rows.selectExpr("o_orderkey", "parse_date_br(d) as day", "normalize_apf(x) as k")

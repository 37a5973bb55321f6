"""Joins, aggregations, windows and report shaping over the order star."""

from __future__ import annotations

from pyspark.sql import functions as F

from marajo.operators import tables as T
from marajo.plans.kit import Kit

kit = Kit()
QUERIES, ORACLES = kit.queries, kit.oracles

MONTHLY = """m as (select cast(date_trunc('month', o_orderdate) as date) as month, o_orderstatus as status,
  sum(cast(round(o_totalprice * 100) as bigint)) / 100.0 as total, count(*) as n from orders group by 1, 2)"""


def _sum(col):
    """Sum of money in cents, so that the order of addition can't show."""
    return F.sum(F.round(F.col(col) * 100).cast("long")) / 100.0


def _monthly(t):
    """Orders at the month grain by status: the small table that series windows run on."""
    month = F.trunc(F.to_date("o_orderdate"), "month").alias("month")
    return t("orders").groupBy(month, F.col("o_orderstatus").alias("status")).agg(_sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n"))


def _customers(t):
    nation = t("nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = t("region").withColumnRenamed("r_regionkey", "n_regionkey")
    return T.enrich(t("customer"), [(nation, "c_nationkey"), (region, "n_regionkey")])


# --- joins --------------------------------------------------------------------------------------------------


@kit.query("j1_star_enrich", """
select c_custkey, n_name, r_name, coalesce(n_orders, 0) as n_orders from customer left join nation on c_nationkey = n_nationkey
left join region on n_regionkey = r_regionkey left join (select o_custkey, count(*) as n_orders from orders group by 1) on o_custkey = c_custkey""")
def _(t):
    orders = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    return T.enrich(_customers(t), [(orders, "c_custkey")]).select("c_custkey", "n_name", "r_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


@kit.query("j2_inner", "select o_orderkey, c_mktsegment from orders join customer on o_custkey = c_custkey where o_totalprice > 100000")
def _(t):
    big = t("orders").where("o_totalprice > 100000")
    return big.join(t("customer"), big.o_custkey == F.col("c_custkey")).select("o_orderkey", "c_mktsegment")


@kit.query("j3_full_outer", """
with a as (select cast(date_trunc('month', o_orderdate) as date) as month, count(*) as n_a from orders where o_orderstatus = 'F' group by 1),
b as (select cast(date_trunc('month', o_orderdate) as date) as month, count(*) as n_b from orders where o_orderstatus = 'O' group by 1)
select coalesce(a.month, b.month) as month, n_a, n_b from a full join b on a.month = b.month""", dates="month")
def _(t):
    m = _monthly(t)
    a = m.where("status = 'F'").select("month", F.col("n").alias("n_a"))
    return T.full_outer_coalesce(a, m.where("status = 'O'").select("month", F.col("n").alias("n_b")), "month")


@kit.query("j4_root_join", """
select c_custkey, count(*) as n from customer join orders on right(lpad(cast(c_custkey as varchar), 8, '0'), 6) = left(lpad(cast(o_custkey as varchar), 6, '0') || '99', 6)
group by c_custkey""")
def _(t):
    root_a = F.right(F.lpad(F.col("c_custkey").cast("string"), 8, "0"), F.lit(6))
    root_b = F.left(F.concat(F.lpad(F.col("o_custkey").cast("string"), 6, "0"), F.lit("99")), F.lit(6))
    return T.join_on_root(t("customer"), t("orders"), root_a, root_b).groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n"))


@kit.query("j5_prior_year", f"""
with {MONTHLY}, k as (select cast(year(month) as int) as y, cast(month(month) as int) as mo, status, n from m)
select c.y, c.mo, c.status, c.n, a.n as n_prior from k c left join k a on a.status = c.status and a.mo = c.mo and a.y = c.y - 1""")
def _(t):
    k = _monthly(t).select(F.year("month").alias("y"), F.month("month").alias("mo"), "status", "n")
    return T.join_prior(k, ["status", "mo"], "y", ["n"])


@kit.query("j6_cross_scalars", """
select (select count(*) from orders) as n_orders, (select count(*) from customer) as n_customers, (select max(p_size) from part) as max_size""")
def _(t):
    count = lambda name, alias: t(name).agg(F.count(F.lit(1)).alias(alias))
    return T.cross_scalars(count("orders", "n_orders"), count("customer", "n_customers"), t("part").agg(F.max("p_size").alias("max_size")))


@kit.query("j7_densify", """
with f as (select c_nationkey, c_mktsegment as segment, count(*) as n from customer where c_acctbal > 5000 group by 1, 2),
g as (select k.c_nationkey, s.segment, s.position from (select distinct c_nationkey from f) k,
  (values ('BUILDING', 1), ('FURNITURE', 2), ('NONE SUCH', 3)) s(segment, position))
select g.c_nationkey, g.segment, coalesce(n, 0) as n, g.position from g left join f on f.c_nationkey = g.c_nationkey and f.segment = g.segment""")
def _(t):
    facts = t("customer").where("c_acctbal > 5000").groupBy("c_nationkey", F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    return T.densify(facts, "c_nationkey", "segment", ["BUILDING", "FURNITURE", "NONE SUCH"], ["n"])


PERIODS = [("JUN 97", "1997-06-01", "1997-05-01", "1996-06-01"), ("JAN 98", "1998-01-01", "1997-12-01", "1997-01-01"), ("FAR", "2030-01-01", "2029-12-01", "2029-01-01")]


@kit.query("j8_compare_at_dates", f"""
with {MONTHLY}, p(period, now, before, year_before) as (values {", ".join(f"('{a}', date '{b}', date '{c}', date '{d}')" for a, b, c, d in PERIODS)}),
f as (select month, n from m where status = 'F'), o as (select month, total from m where status = 'O')
select period, now, before, year_before, f1.n as f_now, f2.n as f_before, f3.n as f_year_before, o1.total as o_now, o2.total as o_before, o3.total as o_year_before
from p left join f f1 on f1.month = now left join f f2 on f2.month = before left join f f3 on f3.month = year_before
left join o o1 on o1.month = now left join o o2 on o2.month = before left join o o3 on o3.month = year_before""", dates="now before year_before")
def _(t):
    p = t.spark.createDataFrame(PERIODS, "period string, now string, before string, year_before string")
    p = p.withColumns({c: F.col(c).cast("date") for c in ("now", "before", "year_before")})
    m = _monthly(t)
    series = {"f": (m.where("status = 'F'"), "month", "n"), "o": (m.where("status = 'O'"), "month", "total")}
    return T.compare_at_dates(p, series, ["now", "before", "year_before"])


@kit.query("j9_unprocessed", """
select o_orderkey as path from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 10)""")
def _(t):
    files = t("orders").select(F.col("o_orderkey").alias("path"))
    return T.unprocessed(files, t("lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("path")))


@kit.query("j10_order_by_lookup", "select n_name, n_regionkey from nation")
def _(t):
    lookup = t("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("rank"))
    return T.order_by_lookup(t("nation").select("n_name", "n_regionkey"), lookup, "n_regionkey", "rank")


# --- aggregations -------------------------------------------------------------------------------------------


@kit.query("a1_group_sums", """
select o_orderstatus, count(*) as n, sum(cast(round(o_totalprice * 100) as bigint)) / 100.0 as total, min(o_totalprice) as low, max(o_totalprice) as high
from orders group by 1""")
def _(t):
    return t("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), _sum("o_totalprice").alias("total"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))


@kit.query("a2_count_distinct", "select l_returnflag, count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers from lineitem group by 1")
def _(t):
    return t("lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))


@kit.query("a3_pivot_codes", f"""
with {MONTHLY} select month, max(case when status = 'F' then n end) as finished, max(case when status = 'O' then n end) as pending from m group by month""", dates="month")
def _(t):
    return T.pivot_codes(_monthly(t), "month", "status", "n", {"F": "finished", "O": "pending"})


@kit.query("a4_pivot_periods", """
select o_orderstatus, count(*) filter (year(o_orderdate) = 1996) as y1996, count(*) filter (year(o_orderdate) = 1997) as y1997 from orders group by 1""")
def _(t):
    rows = t("orders").groupBy("o_orderstatus", F.concat(F.lit("y"), F.year("o_orderdate").cast("string")).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return T.pivot_periods(rows, "o_orderstatus", "y", "n", ["y1996", "y1997"]).fillna(0)


@kit.query("a5_count_if", "select l_linestatus, count(*) filter (l_quantity < 10) as small, count(*) filter (l_discount >= 0.05) as cheap from lineitem group by 1")
def _(t):
    return t("lineitem").groupBy("l_linestatus").agg(F.count_if(F.col("l_quantity") < 10).alias("small"), F.count_if(F.col("l_discount") >= 0.05).alias("cheap"))


@kit.query("a6_weighted_avg", """
select l_suppkey, case when sum(case when l_linenumber > 3 then l_quantity else 0 end) > 0
  then round(sum(l_discount * case when l_linenumber > 3 then l_quantity else 0 end) / sum(case when l_linenumber > 3 then l_quantity else 0 end), 2) else 0.0 end as avg_discount
from lineitem group by 1""")
def _(t):
    w = F.when(F.col("l_linenumber") > 3, F.col("l_quantity")).otherwise(0.0)
    return t("lineitem").groupBy("l_suppkey").agg(T.weighted_avg(F.col("l_discount"), w).alias("avg_discount"))


@kit.query("a7_ratio_of_sums", """
select l_returnflag, round(sum(cast(l_quantity as bigint)) * 1.0 / count(*) * 100, 2) as rate from lineitem group by 1""")
def _(t):
    return t("lineitem").groupBy("l_returnflag").agg(T.ratio_of_sums(F.col("l_quantity"), F.lit(1)).alias("rate"))


@kit.query("a8_with_total", """
with s as (select cast(year(o_orderdate) as int) as y, o_orderstatus as status, count(*) as n from orders group by 1, 2)
select y, status, cast(n as bigint) as n from s union all select y, 'TOTAL', cast(sum(n) as bigint) from s group by y""")
def _(t):
    rows = t("orders").select(F.year("o_orderdate").alias("y"), F.col("o_orderstatus").alias("status"), F.lit(1).alias("n"))
    return T.with_total(rows, ["y"], "status", ["n"])


@kit.query("a9_two_level", """
with c as (select n_name as unit, r_name as region, c_custkey, c_mktsegment, cast(round(c_acctbal) as bigint) as balance, cast(c_custkey % 10 as double) as score
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
u as (select unit, region, count(distinct c_mktsegment) as segments, sum(balance) as balance, avg(score) as score from c group by 1, 2)
select unit as area, region, 'unit' as level, segments, cast(balance as bigint) as balance, round(score, 1) as score from u
union all select region, region, 'region', cast(sum(segments) as bigint), cast(sum(balance) as bigint), round(avg(score), 1) from u group by region""")
def _(t):
    c = _customers(t).select(
        F.col("n_name").alias("unit"), F.col("r_name").alias("region"), "c_mktsegment", F.round("c_acctbal").cast("long").alias("balance"), (F.col("c_custkey") % 10).cast("double").alias("score")
    )
    return T.two_level(c, "unit", "region", {"segments": "c_mktsegment"}, ["balance"], ["score"])


@kit.query("a10_share_of_total", """
with s as (select cast(year(o_orderdate) as int) as y, o_orderstatus as status, count(*) as n from orders group by 1, 2),
u as (select y, status, n from s union all select y, 'TOTAL', sum(n) from s group by y)
select y, status, cast(n as bigint) as n, round(n * 100.0 / sum(case when status <> 'TOTAL' then n end) over (partition by y), 1) as n_share from u""")
def _(t):
    rows = t("orders").select(F.year("o_orderdate").alias("y"), F.col("o_orderstatus").alias("status"), F.lit(1).alias("n"))
    return T.share_of_total(T.with_total(rows, ["y"], "status", ["n"]), ["y"], "status", ["n"])


BANDS = ([10, 25, 40], ["up to 10", "11 to 25", "26 to 40", "over 40"])


@kit.query("a11_band_counts", """
select p_brand, case when p_size <= 10 then 'up to 10' when p_size <= 25 then '11 to 25' when p_size <= 40 then '26 to 40' else 'over 40' end as band,
  count(*) as n, case when p_size <= 10 then 1 when p_size <= 25 then 2 when p_size <= 40 then 3 else 4 end as position from part group by all""")
def _(t):
    return T.band_counts(t("part"), ["p_brand"], "p_size", *BANDS)


@kit.query("a12_monthly_totals", """
select l_suppkey, cast(date_trunc('month', l_shipdate) as date) as month, count(*) as n, sum(l_quantity) as l_quantity from lineitem group by 1, 2""", dates="month")
def _(t):
    return T.monthly_totals(t("lineitem"), ["l_suppkey"], "l_shipdate", ["l_quantity"])


@kit.query("a13_risk_score", """
with a as (select l_suppkey, count(*) filter (l_discount > 0.08) as late, count(*) filter (l_returnflag = 'R') as stopped from lineitem where l_quantity > 48 group by 1)
select l_suppkey, late, stopped, late + 2 * stopped as risk_score,
  case when late + 2 * stopped <= 0 then 'low' when late + 2 * stopped <= 3 then 'medium' else 'high' end as risk_class from a""")
def _(t):
    a = t("lineitem").where("l_quantity > 48").groupBy("l_suppkey").agg(F.count_if(F.col("l_discount") > 0.08).alias("late"), F.count_if(F.col("l_returnflag") == "R").alias("stopped"))
    return T.risk_score(a, {"late": 1, "stopped": 2}, [(0, "low"), (3, "medium")], "high")


@kit.query("a14_latest_stamp", """
select o_orderkey, greatest(max(o_orderdate), max(l_shipdate)) as stamp from orders left join lineitem on l_orderkey = o_orderkey group by 1""")
def _(t):
    both = t("orders").join(t("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return both.groupBy("o_orderkey").agg(F.max("o_orderdate").alias("a"), F.max("l_shipdate").alias("b")).select("o_orderkey", T.latest_stamp("a", "b").alias("stamp"))


@kit.query("a15_distinct", "select distinct p_brand, p_type from part")
def _(t):
    return t("part").select("p_brand", "p_type").distinct()


# --- windows ------------------------------------------------------------------------------------------------


@kit.query("w1_pct_change", f"""
with {MONTHLY} select month, status, round((n * 1.0 / nullif(lag(n, 1) over w, 0) - 1) * 100, 1) as on_month,
  round((n * 1.0 / nullif(lag(n, 3) over w, 0) - 1) * 100, 1) as on_quarter, round((n * 1.0 / nullif(lag(n, 12) over w, 0) - 1) * 100, 1) as on_year
from m window w as (partition by status order by month)""", dates="month")
def _(t):
    m = _monthly(t)
    for k, name in ((1, "on_month"), (3, "on_quarter"), (12, "on_year")):
        m = T.pct_change(m, "n", "month", k, ["status"], name=name)
    return m.select("month", "status", "on_month", "on_quarter", "on_year")


@kit.query("w2_ratio_of_rates", f"""
with {MONTHLY} select month, status, round((1 + n / 1000.0) / (1 + lag(n / 1000.0, 12) over (partition by status order by month)) - 1, 6) as r from m""", dates="month")
def _(t):
    m = _monthly(t).withColumn("rate", F.col("n") / 1000.0)
    return T.ratio_of_rates(m, "rate", "month", 12, ["status"], "r").select("month", "status", F.round("r", 6).alias("r"))


@kit.query("w3_rolling_sum", f"""
with {MONTHLY} select month, status, cast(sum(n) over (partition by status order by month rows between 11 preceding and current row) as bigint) as n12 from m""", dates="month")
def _(t):
    return T.rolling_sum(_monthly(t), "n", "month", 12, ["status"], "n12").select("month", "status", "n12")


@kit.query("w4_ytd", f"""
with {MONTHLY} select month, status, cast(year(month) as int) as y, n, cast(sum(n) over w as bigint) as n_ytd, max(n) over w as n_ytd_max
from m window w as (partition by status, year(month) order by month)""", dates="month")
def _(t):
    m = _monthly(t).select("month", "status", F.year("month").alias("y"), "n")
    return T.ytd(m, "n", "y", "month", ["status"])


@kit.query("w5_cumulative_progress", """
with s as (select l_suppkey, cast(date_trunc('month', l_shipdate) as date) as month, sum(cast(l_quantity as bigint)) as q from lineitem group by 1, 2),
k as (select l_suppkey, sum(q) as total from s group by 1)
select s.l_suppkey, month, cast(sum(q) over w as bigint) as accumulated, round(sum(q) over w * 100.0 / total, 2) as progress
from s join k using (l_suppkey) window w as (partition by s.l_suppkey order by month)""", dates="month")
def _(t):
    month = F.trunc(F.to_date("l_shipdate"), "month").alias("month")
    s = t("lineitem").groupBy("l_suppkey", month).agg(F.sum(F.col("l_quantity").cast("long")).alias("q"))
    k = t("lineitem").groupBy("l_suppkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("total"))
    return T.cumulative_progress(s.join(k, "l_suppkey"), "l_suppkey", "month", "q", "total").select("l_suppkey", "month", "accumulated", "progress")


@kit.query("w6_period_close", """
select event_type, cast(date_trunc('month', ts) as date) as period, max_by(value, ts) as value
from (select event_type, ts, max(value) as value from events group by 1, 2) group by 1, 2""", dates="period")
def _(t):
    unique = t("events").groupBy("event_type", "ts").agg(F.max("value").alias("value"))
    return T.period_close(unique, ["event_type"], "ts", "value")


@kit.query("w7_change_since_start", f"""
with {MONTHLY} select month, status, round((n * 1.0 / nullif(first_value(n) over (partition by status order by month), 0) - 1) * 100, 1) as n_since_start from m""", dates="month")
def _(t):
    return T.change_since_start(_monthly(t), "n", "month", ["status"]).select("month", "status", "n_since_start")


@kit.query("w8_change_since_base", f"""
with {MONTHLY}, b as (select status, n as base from m where month = date '1996-10-01')
select m.month, m.status, round((n * 1.0 / nullif(base, 0) - 1) * 100, 1) as n_since_base from m left join b on b.status = m.status""", dates="month")
def _(t):
    m = _monthly(t)
    import datetime

    return T.change_since_base(m, "n", "month", datetime.date(1996, 10, 1), ["status"]).select("month", "status", "n_since_base")


@kit.query("w9_latest_per_key", """
select o_custkey, o_orderkey, o_totalprice from orders
qualify row_number() over (partition by o_custkey order by case when o_orderstatus = 'P' then null else o_orderdate end desc nulls first, o_orderkey desc) = 1""")
def _(t):
    rows = t("orders").withColumn("at", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return T.latest_per_key(rows, "o_custkey", ["at", "o_orderkey"], nulls="first").select("o_custkey", "o_orderkey", "o_totalprice")


@kit.query("w10_best_record", """
select o_custkey, o_orderkey from (select *, case when o_orderstatus = 'F' then o_orderdate end as ended, case when o_orderkey % 7 > 0 then o_orderdate end as began from orders)
qualify row_number() over (partition by o_custkey order by ended is null desc, began desc nulls last, o_orderkey) = 1""")
def _(t):
    rows = t("orders").select(
        "o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("ended"), F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderdate")).alias("began")
    )
    return T.best_record(rows, "o_custkey", "ended", "began", "o_orderkey").select("o_custkey", "o_orderkey")


@kit.query("w11_locf", f"""
with {MONTHLY}, a as (select month, n as a from m where status = 'P'), b as (select month, n as b from m where status = 'O'),
u as (select coalesce(a.month, b.month) as month, a, b from a full join b on a.month = b.month)
select month, coalesce(last_value(a ignore nulls) over w, 0) as a, coalesce(last_value(b ignore nulls) over w, 0) as b
from u window w as (order by month rows between unbounded preceding and current row)""", dates="month")
def _(t):
    m = _monthly(t)
    side = lambda s, name: m.where(F.col("status") == s).select("month", F.col("n").alias(name))
    both = T.full_outer_coalesce(side("P", "a"), side("O", "b"), "month").withColumn("series", F.lit(1))
    return T.locf(both, "series", "month", ["a", "b"], 0).select("month", "a", "b")


# --- report shaping -----------------------------------------------------------------------------------------


@kit.query("s1_order_by_rank", "select r_regionkey, r_name from region")
def _(t):
    return T.order_by_rank(t("region").select("r_regionkey", "r_name"), "r_name", ["EUROPE", "ASIA", "AFRICA"])


@kit.query("s2_order_desc", "select o_orderkey, o_totalprice from orders order by o_totalprice desc")
def _(t):
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"))


@kit.query("s3_top_n", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100")
def _(t):
    return T.top_n(t("orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 100, ["o_orderkey"])


@kit.query("s4_union_all", "select c_custkey as k, 'customer' as kind from customer union all select s_suppkey, 'supplier' from supplier")
def _(t):
    return t("customer").select(F.col("c_custkey").alias("k"), F.lit("customer").alias("kind")).unionByName(t("supplier").select(F.col("s_suppkey").alias("k"), F.lit("supplier").alias("kind")))


@kit.query("s5_unpivot_groups", """
with w as (select l_orderkey, l_linenumber, case when l_quantity > 25 then l_quantity end as a_q, case when l_tax > 0.04 then l_tax end as a_t,
  case when l_quantity > 45 then l_quantity end as b_q, case when l_discount > 0.08 then l_discount end as b_t from lineitem)
select l_orderkey, l_linenumber, 'A' as entity, a_q as q, a_t as x from w where a_q is not null or a_t is not null
union all select l_orderkey, l_linenumber, 'B', b_q, b_t from w where b_q is not null or b_t is not null""")
def _(t):
    c = F.col
    w = t("lineitem").select(
        "l_orderkey", "l_linenumber", F.when(c("l_quantity") > 25, c("l_quantity")).alias("a_q"), F.when(c("l_tax") > 0.04, c("l_tax")).alias("a_t"),
        F.when(c("l_quantity") > 45, c("l_quantity")).alias("b_q"), F.when(c("l_discount") > 0.08, c("l_discount")).alias("b_t"),
    )
    return T.unpivot_groups(w, ["l_orderkey", "l_linenumber"], {"A": {"q": "a_q", "x": "a_t"}, "B": {"q": "b_q", "x": "b_t"}})


TABLE = [("DEC 97", "1997-12-01", "1997-12-01"), ("NOV 97", "1997-11-01", "1997-11-01"), ("DEC 96", "1996-12-01", "1996-12-01"), ("12 MONTHS 97", "1997-01-01", "1997-12-01"), ("NONE", "2050-01-01", "2050-12-01")]


@kit.query("s6_period_table", f"""
with {MONTHLY}, p(position, period, a, b) as (values {", ".join(f"({i}, '{n}', date '{a}', date '{b}')" for i, (n, a, b) in enumerate(TABLE, 1))})
select position, period, round(sum(total), 2) as total, cast(sum(n) as bigint) as n from p left join m on month between a and b group by 1, 2""")
def _(t):
    return T.period_table(_monthly(t), "month", ["total", "n"], TABLE).withColumn("total", F.round("total", 2))


@kit.query("s7_quarter_comparison", """
with q as (select o_orderpriority as e, cast(year(o_orderdate) as int) * 4 + quarter(o_orderdate) as t, count(*) as v from orders group by 1, 2),
s as (select e, sum(v) filter (t = 7990) as p0, sum(v) filter (t = 7989) as p1, sum(v) filter (t = 7986) as p4, sum(v) filter (t between 7987 and 7990) as y0,
  sum(v) filter (t between 7983 and 7986) as y4, sum(v) filter (t between 7979 and 7982) as y8 from q group by 1)
select e, round((p0 * 1.0 / nullif(p1, 0) - 1) * 100, 0) as on_quarter, round((p0 * 1.0 / nullif(p4, 0) - 1) * 100, 0) as on_year,
  round((y0 * 1.0 / nullif(y4, 0) - 1) * 100, 0) as four_quarters, round((y4 * 1.0 / nullif(y8, 0) - 1) * 100, 0) as four_quarters_before
from s where p0 is not null""")
def _(t):
    q = t("orders").groupBy(F.col("o_orderpriority").alias("e"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")).agg(F.count(F.lit(1)).alias("v"))
    return T.quarter_comparison(q, "e", "v", "y", "q", (1997, 2))


@kit.query("s8_year_matrix", """
with b as (select cast(year(o_orderdate) as int) as y, count(*) as t1, count(*) filter (o_orderstatus = 'F') as u1, count(*) filter (o_orderstatus = 'O') as u2 from orders where year(o_orderdate) in (1996, 1997) group by 1),
a as (select * from b where y = 1996), c as (select * from b where y = 1997)
select 1 as position, 'ALL' as category, cast(a.u1 as double) as used_a, cast(a.t1 - a.u1 as double) as new_a, cast(c.u1 as double) as used_b,
  round((c.u1 * 1.0 / nullif(a.u1, 0) - 1) * 100, 0) as used_change, cast(c.t1 - c.u1 as double) as new_b, round(((c.t1 - c.u1) * 1.0 / nullif(a.t1 - a.u1, 0) - 1) * 100, 0) as new_change from a, c
union all select 2, 'ONLY USED', cast(a.u2 as double), null, cast(c.u2 as double), round((c.u2 * 1.0 / nullif(a.u2, 0) - 1) * 100, 0), null, null from a, c
union all select 3, 'ONLY NEW', null, cast(a.t1 as double), null, null, cast(c.t1 as double), round((c.t1 * 1.0 / nullif(a.t1, 0) - 1) * 100, 0) from a, c""")
def _(t):
    is_ = lambda s: (F.col("o_orderstatus") == s).cast("int")
    rows = t("orders").select(F.year("o_orderdate").alias("y"), F.lit(1).alias("t1"), is_("F").alias("u1"), is_("O").alias("u2"))
    return T.year_matrix(rows, "y", (1996, 1997), {"ALL": ("t1", "u1"), "ONLY USED": (None, "u2"), "ONLY NEW": ("t1", None)})


STATE_PANEL = """
with f as (select n_name as uf, c_mktsegment as method, c_custkey, cast(round(c_acctbal) as bigint) as v, cast(c_custkey % 101 as double) as pct from customer join nation on c_nationkey = n_nationkey),
cats(dimension, position) as (values ('BUILDING', 1), ('MACHINERY', 2), ('HOUSEHOLD', 3)),
grid as (select uf, dimension, position from (select distinct uf from f), cats),
panel as (
select uf, 'header' as section, 'summary' as dimension, 0 as position, count(*) as n, sum(v) as v from f group by uf
union all select uf, 'method', method, 0, count(*), sum(v) from f group by uf, method
union all select g.uf, 'status', g.dimension, g.position, coalesce(n, 0), coalesce(v, 0) from grid g
  left join (select uf, method, count(*) as n, sum(v) as v from f group by 1, 2) r on r.uf = g.uf and r.method = g.dimension
union all select uf, 'execution', case when pct <= 40 then 'up to 40' when pct <= 55 then '41 to 55' when pct <= 75 then '56 to 75' else 'over 75' end,
  case when pct <= 40 then 1 when pct <= 55 then 2 when pct <= 75 then 3 else 4 end, count(*), sum(v) from f group by all)
select uf, section, dimension, cast(position as int) as position, cast(n as bigint) as n, cast(v as bigint) as v from panel"""


@kit.query("s9_state_panel", STATE_PANEL)
def _(t):
    f = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("uf"), F.col("c_mktsegment").alias("method"), F.round("c_acctbal").cast("long").alias("v"), (F.col("c_custkey") % 101).cast("double").alias("pct")
    )
    measures = (F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))
    at = lambda df: df.withColumn("position", F.lit(0))
    by_method = f.groupBy("uf", F.col("method").alias("dimension")).agg(*measures)
    bands = T.band_counts(f, ["uf"], "pct", [40, 55, 75], ["up to 40", "41 to 55", "56 to 75", "over 75"], "v").withColumnRenamed("band", "dimension")
    panel = T.sectioned_panel({
        "header": at(f.groupBy("uf").agg(*measures).withColumn("dimension", F.lit("summary"))),
        "method": at(by_method),
        "status": T.densify(by_method, "uf", "dimension", ["BUILDING", "MACHINERY", "HOUSEHOLD"], ["n", "v"]),
        "execution": bands,
    })
    return panel.select("uf", "section", "dimension", "position", "n", "v")


@kit.query("s10_classify_status", """
with w as (select o_orderkey, cast(o_orderkey % 101 as double) as physical, cast(o_custkey % 101 as double) as financial, cast(o_orderdate as date) as due, o_orderstatus = 'F' as delivered from orders)
select o_orderkey, case when physical = 100 then 'complete' when physical = 0 then 'not started' when physical > 0 and physical < 100 then 'in progress' else 'unknown' end as execution,
  case when delivered then 'delivered' when due < date '1998-01-01' then 'late' else 'in time' end as deadline,
  case when financial > physical + 5 then 'money ahead' when financial < physical - 5 then 'money behind' else 'balanced' end as pace from w""")
def _(t):
    w = t("orders").select(
        "o_orderkey", (F.col("o_orderkey") % 101).cast("double").alias("physical"), (F.col("o_custkey") % 101).cast("double").alias("financial"),
        F.to_date("o_orderdate").alias("due"), (F.col("o_orderstatus") == "F").alias("delivered"),
    )
    return T.classify_status(w, "1998-01-01").select("o_orderkey", "execution", "deadline", "pace")


@kit.query("s11_series_slice", f"""
with {MONTHLY}, w as (select month, max(case when status = 'F' then n end) as f, max(case when status = 'P' then n end) as p from m group by month)
select month as date, f, p from w where p is not null""", dates="date")
def _(t):
    wide = T.pivot_codes(_monthly(t), "month", "status", "n", {"F": "f", "P": "p"})
    return T.series_slice(wide, F.col("month"), ["f", "p"], ["p"])

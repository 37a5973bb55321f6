"""Bulletin pipelines over raw text tables that are derived from the order star.

The raw tables write clean columns the way the sources do (Brazilian money and dates, dashed keys); the SQL takes
the clean columns.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marajo.plans import bulletins as B
from marajo.plans.kit import Kit
from marajo.session import checkpoint_root, stash
from marajo.sources import files as S

kit = Kit()
QUERIES, ORACLES = kit.queries, kit.oracles


def _br(c):
    return F.translate(F.format_number(c, 2), ",.", ".,")


def _day(c):
    return F.date_format(c, "dd/MM/yyyy")


# --- bulletins ----------------------------------------------------------------------------------------------


@kit.query("p2_mortgage_credit", """
select cast(date_trunc('month', o_orderdate) as date) as data_referencia, max(case when o_orderpriority = '1-URGENT' then c end) as total, max(case when o_orderpriority = '2-HIGH' then c end) as market
from (select date_trunc('month', o_orderdate) as o_orderdate, o_orderpriority, cast(count(*) as double) as c from orders group by 1, 2) group by 1""", dates="data_referencia")
def _(t):
    month = F.date_trunc("month", "o_orderdate")
    raw = t("orders").groupBy(F.col("o_orderpriority").alias("tipo"), _day(month).alias("data")).agg(F.concat(F.count(F.lit(1)).cast("string"), F.lit(",0")).alias("valor"))
    return B.mortgage_credit(raw, {"1-URGENT": "total", "2-HIGH": "market"})


@kit.query("p4_cost_index", """
with m as (select cast(date_trunc('month', o_orderdate) as date) as d, cast(count(*) as double) as i from orders group by 1)
select d as data_referencia, case when month(d) <> 5 then i end as indice, cast(year(d) as int) as ano, cast(quarter(d) as int) as trimestre,
  round((case when month(d) <> 5 then i end / nullif(lag(case when month(d) <> 5 then i end, 3) over (order by d), 0) - 1) * 100, 2) as var_tri from m""", dates="data_referencia")
def _(t):
    month = F.date_trunc("month", "o_orderdate")
    raw = t("orders").groupBy(F.date_format(month, "MM/yyyy").alias("mes")).agg(F.count(F.lit(1)).alias("n"))
    text = F.when(F.left("mes", F.lit(2)) == "05", "...").otherwise(F.col("n").cast("string"))
    raw = raw.select("mes", text.alias("indice"), *[F.lit("..").alias(c) for c in ("var_mes", "var_ano", "var_12_meses")])
    return B.cost_index(raw).select("data_referencia", "indice", "ano", "trimestre", "var_tri")


@kit.query("p10_stock_index", """
with d as (select cast(o_orderdate as date) as d, max(o_totalprice) as c from orders where o_orderpriority = '1-URGENT' group by 1),
m as (select cast(date_trunc('month', d) as date) as data_referencia, max_by(c, d) as close from d group by 1)
select data_referencia, close, round((close / nullif(lag(close) over w, 0) - 1) * 100, 1) as var_mes, round((close / nullif(lag(close, 12) over w, 0) - 1) * 100, 1) as var_12_meses,
  round((close / nullif(first_value(close) over w, 0) - 1) * 100, 1) as var_acum_serie from m window w as (order by data_referencia)""", dates="data_referencia")
def _(t):
    raw = t("orders").groupBy(F.col("o_orderpriority").alias("symbol"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("data_pregao")).agg(F.max("o_totalprice").cast("string").alias("close"))
    return B.stock_index(raw, "1-URGENT")


@kit.query("p11_jobs", """
with q as (select cast(year(o_orderdate) as int) as ano, cast(quarter(o_orderdate) as int) as trimestre, cast(min(month(o_orderdate)) as int) as mes_ini, cast(max(month(o_orderdate)) as int) as mes_fim,
  count(*) as saldo_tri from orders group by 1, 2),
s as (select ano, trimestre, max(n) as estoque_fim_tri from (select cast(year(o_orderdate) as int) as ano, cast(quarter(o_orderdate) as int) as trimestre, month(o_orderdate), count(distinct o_custkey) as n from orders group by 1, 2, 3) group by 1, 2)
select ano, trimestre, mes_ini, mes_fim, saldo_tri, estoque_fim_tri, round((saldo_tri * 1.0 / nullif(lag(saldo_tri) over w, 0) - 1) * 100, 0) as saldo_var_tri,
  round((estoque_fim_tri * 1.0 / nullif(lag(estoque_fim_tri, 4) over w, 0) - 1) * 100, 0) as estoque_var_ano,
  cast(sum(saldo_tri) over (partition by ano order by trimestre) as bigint) as saldo_tri_ytd, max(estoque_fim_tri) over (partition by ano order by trimestre) as estoque_fim_tri_ytd_max
from q join s using (ano, trimestre) window w as (order by ano, trimestre)""")
def _(t):
    monthly = t("orders").groupBy(F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes")).agg(F.count(F.lit(1)).alias("saldo"), F.count_distinct("o_custkey").alias("estoque"))
    return B.jobs(monthly)


@kit.query("p12_loans_by_lender", """
with b as (select cast(year(o_orderdate) as int) as ano, cast(month(o_orderdate) as int) as mes, case o_orderpriority when '1-URGENT' then 'FIRST' when '2-HIGH' then 'SECOND' else 'DEMAIS' end as banco,
  count(*) as uh, sum(o_custkey) as valor from orders group by 1, 2, 3),
u as (select ano, mes, banco, uh, valor from b union all select ano, mes, 'TOTAL', sum(uh), sum(valor) from b group by 1, 2),
s as (select *, sum(case when banco <> 'TOTAL' then uh end) over (partition by ano, mes) as tu, sum(case when banco <> 'TOTAL' then valor end) over (partition by ano, mes) as tv from u),
r as (select ano, mes, banco, cast(round(valor / 1000.0, 1) as double) as valor_bi, round(valor * 100.0 / tv, 1) as perc_valor, cast(uh as bigint) as uh, round(uh * 100.0 / tu, 1) as perc_uh from s)
select c.ano, c.mes, c.banco, c.valor_bi, c.perc_valor, round((c.valor_bi / nullif(a.valor_bi, 0) - 1) * 100, 0) + 0.0 as var_ano_valor, c.uh, c.perc_uh,
  round((c.uh * 1.0 / nullif(a.uh, 0) - 1) * 100, 0) + 0.0 as var_ano_uh, case c.banco when 'TOTAL' then 0 when 'FIRST' then 1 when 'SECOND' then 2 else 3 end as ordem
from r c left join r a on a.banco = c.banco and a.mes = c.mes and a.ano = c.ano - 1""")
def _(t):
    raw = t("orders").select(
        F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes"), F.col("o_orderpriority").alias("agente"), F.col("o_custkey").alias("posicao_ano_rs_milhoes"), F.lit(1).alias("posicao_ano_unidades")
    )
    return B.loans_by_lender(raw, {"1-URGENT": "FIRST", "2-HIGH": "SECOND"})


@kit.query("p18_company_balances", """
with q as (select o_orderpriority as empresa, cast(year(o_orderdate) as int) * 4 + quarter(o_orderdate) as t, count(*) as v from orders where o_orderpriority < '4' group by 1, 2),
s as (select empresa, sum(v) filter (t = 7996) as p0, sum(v) filter (t = 7995) as p1, sum(v) filter (t = 7992) as p4, sum(v) filter (t between 7993 and 7996) as y0,
  sum(v) filter (t between 7989 and 7992) as y4, sum(v) filter (t between 7985 and 7988) as y8 from q group by 1)
select empresa, round((p0 * 1.0 / nullif(p1, 0) - 1) * 100, 0) as on_quarter, round((p0 * 1.0 / nullif(p4, 0) - 1) * 100, 0) as on_year,
  round((y0 * 1.0 / nullif(y4, 0) - 1) * 100, 0) as four_quarters, round((y4 * 1.0 / nullif(y8, 0) - 1) * 100, 0) as four_quarters_before from s where p0 is not null""")
def _(t):
    q = t("orders").where("o_orderpriority < '4'").groupBy(F.col("o_orderpriority").alias("empresa"), F.year("o_orderdate").alias("ano"), F.quarter("o_orderdate").alias("trimestre")).agg(F.count(F.lit(1)).alias("v"))
    return B.company_balances(q, "v", (1998, 4), ["3-MEDIUM", "1-URGENT"])


@kit.query("p29_federal_budget", """
with r as (select l_shipyear as a, case l_shipyear when 'A' then 'FAR' when 'N' then 'FDS' end as acao_nome, sum(cast(round(l_extendedprice * 100) as bigint)) as x, sum(cast(round(l_tax * 100) as bigint)) as y
  from (select l_returnflag as l_shipyear, l_extendedprice, l_tax from lineitem where l_returnflag in ('A', 'N')) group by 1)
select a as acao_governo_codigo, acao_nome, x / 100.0 as dotacao_atualizada, y / 100.0 as empenho, x / 100.0 as pagamento, cast(null as double) as rap_inscrito, y / 100.0 as pag_rap, (x + y) / 100.0 as pag_total,
  case a when 'A' then 1 else 2 end as ordem from r
union all select 'SOMA', 'SOMA', sum(x) / 100.0, sum(y) / 100.0, sum(x) / 100.0, cast(null as double), sum(y) / 100.0, sum(x + y) / 100.0, 3 from r""")
def _(t):
    text = {"dotacao_atualizada": "l_extendedprice", "despesas_empenhadas": "l_tax", "despesas_pagas": "l_extendedprice", "restos_a_pagar_pagos": "l_tax"}
    raw = t("lineitem").select(F.col("l_returnflag").alias("acao_governo_codigo"), *[_br(F.round(c, 2)).alias(n) for n, c in text.items()], F.lit("").alias("restos_a_pagar_inscritos"))
    out = B.federal_budget(raw, {"A": "FAR", "N": "FDS"})
    return out.withColumns({c: F.col(c).cast("double") for c in (*B.BUDGET_AMOUNTS.values(), "pag_total")})


def _monthly(t):
    """Orders by month: ``m`` (first day), ``n``, ``k`` (sum of keys), ``c`` (customers)."""
    month = F.to_date(F.date_trunc("month", "o_orderdate")).alias("m")
    return t("orders").groupBy(month).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("k"), F.count_distinct("o_custkey").alias("c"))


_M = "m as (select cast(date_trunc('month', o_orderdate) as date) as m, count(*) as n, cast(sum(o_orderkey) as bigint) as k, count(distinct o_custkey) as c from orders group by 1)"


def _savings(t):
    k = F.col("k")
    raw = _monthly(t).select(
        F.date_format("m", "yyyy-MM-dd").alias("data_referencia"), *[(k % (j * 1000)).cast("string").alias(c) for j, c in enumerate(B.SAVINGS, 3)]
    )
    return B.savings(raw)


_SAVINGS = ", ".join(f"cast(k % {j * 1000} as double) as {c}" for j, c in enumerate(B.SAVINGS, 3))


@kit.query("p1_savings", f"""
with {_M}, s as (select m as data_referencia, {_SAVINGS} from m)
select *, round(cast(captacao_liquida_valor as decimal(18, 3)) / 1000, 1) as captacao_liquida_bi, sum(captacao_liquida_valor) over (order by data_referencia rows between 11 preceding and current row) as captacao_acum_12m from s""",
    dates="data_referencia")
def _(t):
    return _savings(t)


@kit.query("p1_savings_periods", f"""
with {_M}, s as (select m as d, k % 5000 as v from m),
p(ordem, periodo, a, b) as (values (1, 'DEZ 1997', date '1997-12-01', date '1997-12-01'), (2, 'NOV 1997', date '1997-11-01', date '1997-11-01'), (3, '12 MESES', date '1997-01-01', date '1997-12-01'), (4, 'LEER', date '2050-01-01', date '2050-01-01'))
select ordem, periodo, round(sum(cast(v as decimal(18, 3))) / 1000, 1) as cap_liq_bi from p left join s on d between a and b group by 1, 2""")
def _(t):
    periods = [("DEZ 1997", "1997-12-01", "1997-12-01"), ("NOV 1997", "1997-11-01", "1997-11-01"), ("12 MESES", "1997-01-01", "1997-12-01"), ("LEER", "2050-01-01", "2050-01-01")]
    return B.savings_periods(_savings(t), periods)


def _confidence(t):
    return B.confidence(_monthly(t).select(
        F.date_format("m", "MM/yyyy").alias("mes"), F.concat((F.col("k") % 900 + 100).cast("string"), F.lit(",5")).alias("icst_com_ajuste_sazonal"), F.concat(F.col("n").cast("string"), F.lit(",25")).alias("icst_sem_ajuste_sazonal"),
    ))


@kit.query("p3_confidence", f"""
with {_M} select m as data_referencia, k % 900 + 100.5 as icst_com_ajuste_sazonal, n + 0.25 as icst_sem_ajuste_sazonal, round(((n + 0.25) / lag(n + 0.25) over w - 1) * 100, 2) as var_mes,
  round(((n + 0.25) / lag(n + 0.25, 12) over w - 1) * 100, 2) as var_12_meses from m window w as (order by m)""", dates="data_referencia")
def _(t):
    return _confidence(t)


def _rent(t):
    rate = lambda c: F.when(F.month("m") != 7, (c / 1000).cast("string")).otherwise("n/d")
    raw = _monthly(t).select(F.col("m").cast("string").alias("data_referencia"), rate(F.col("n") % 90).alias("imoveis_residenciais_locacao_var_mensal_total"), rate(F.col("k") % 200).alias("imoveis_residenciais_locacao_var_ano_total"))
    return B.rent_index(raw)


_RENT = "rent as (select m as data_referencia, case when month(m) <> 7 then (n % 90) / 1000 end as var_mensal, case when month(m) <> 7 then (k % 200) / 1000 end as var_ano from m)"


@kit.query("p5_rent_index", f"""
with {_M}, {_RENT} select *, round(((1 + var_mensal) / (1 + lag(var_mensal, 12) over (order by data_referencia)) - 1) * 100, 2) as var_12_meses_calc from rent""", dates="data_referencia")
def _(t):
    return _rent(t)


_QUARTER = "cast(year(o_orderdate) as varchar) || '0' || cast(quarter(o_orderdate) as varchar)"


def _by_code(t, codes, period, text=True):
    """Long series by month or quarter and code: as many orders as fall to each, in text."""
    code = F.get(F.array(*map(F.lit, codes)), (F.col("o_orderkey") % len(codes)).cast("int"))
    found = t("orders").groupBy(period.alias("periodo"), code.alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return found.withColumn("valor", F.col("n").cast("string")) if text else found.withColumn("valor", F.col("n").cast("double"))


def _code_sql(codes, period):
    names = "[" + ", ".join(f"'{c}'" for c in codes) + "]"
    return f"l as (select {period} as periodo, {names}[o_orderkey % {len(codes)} + 1] as code, count(*) as n from orders group by 1, 2)"


_GDP = ["6562", "6563", "6564", "6561"]


@kit.query("p6_gdp", f"""
with {_code_sql(_GDP, _QUARTER)}
select case code when '6564' then 'Trim./Trim. Imediatamente Anterior' when '6563' then 'Acumulada ao Longo do Ano' else 'Acum. Últimos 4 Trimestres' end as indicador,
  round(max(case when periodo = '199704' and n % 3 > 0 then (1000 + n) / 10 end), 1) as tri_1997_4, round(max(case when periodo = '199801' and n % 3 > 0 then (1000 + n) / 10 end), 1) as tri_1998_1 from l where code <> '6561' group by code""")
def _(t):
    period = F.concat(F.year("o_orderdate").cast("string"), F.lit("0"), F.quarter("o_orderdate").cast("string"))
    long = _by_code(t, _GDP, period)
    # thousands are grouped by a dot, missing values are dashes
    text = F.when(F.col("n") % 3 > 0, F.translate(F.format_number(1000 + F.col("n"), 0), ",", ".")).otherwise(" - ")
    return B.gdp(long.select(F.col("code").alias("variavel_id"), "periodo", text.alias("valor")), {"199704": "tri_1997_4", "199801": "tri_1998_1"})


_MONTH = "strftime(o_orderdate, '%Y%m')"


@kit.query("p7_monthly_volume", f"""
with {_code_sql(["11601", "11603"], _MONTH)}
select code as variavel_id, 'VAR ' || code as variavel_nome, 'TOTAL' as categoria_nome, strptime(periodo || '01', '%Y%m%d')::date as data_referencia, case when n % 4 > 0 then n + 0.5 end as valor from l""", dates="data_referencia")
def _(t):
    long = _by_code(t, ["11601", "11603"], F.date_format("o_orderdate", "yyyyMM"))
    value = F.when(F.col("n") % 4 == 0, F.when(F.col("n") % 8 == 0, "-").otherwise(" ... ")).otherwise(F.concat("valor", F.lit(".5")))
    return B.monthly_volume(long.select(F.col("code").alias("variavel_id"), F.concat(F.lit(" var "), "code").alias("variavel_nome"), F.lit("Total ").alias("categoria_nome"), "periodo", value.alias("valor")))


def _labour(t, name, factor):
    long = _by_code(t, list(B.LABOUR), F.date_format("o_orderdate", "yyyyMM"))
    stamp = F.to_timestamp(F.concat(F.lit("2020-01-"), F.lpad((F.col("n") % 28 + 1).cast("string"), 2, "0")))
    return B.labour_survey(long.select("periodo", F.col("code").alias("categoria_id"), (F.col("n") * factor).cast("string").alias("valor"), stamp.alias("dt_ingest")), name)


@kit.query("p8_labour_report", f"""
with {_code_sql(list(B.LABOUR), _MONTH)},
w as (select periodo, cast(left(periodo, 4) as int) as ano, cast(right(periodo, 2) as int) as mes, cast(max(case when code = '47949' then n end) as double) as c, cast(max(case when code = '47946' then n end) as double) as a,
  max(date '2020-01-01' + cast(n % 28 as int)) as dt from l group by 1),
v as (select *, round((c / lag(c) over o - 1) * 100, 1) as vm, round((c / lag(c, 12) over o - 1) * 100, 1) as va from w window o as (order by periodo))
select ano, cast(ceil(mes / 3) as int) as trimestre, periodo, c as pnad_const_milhares, a as pnad_total_milhares, vm as pnad_const_var_mes, va as pnad_const_var_ano, 3 * c as rend_const_rs, 3 * a as rend_total_rs,
  vm as rend_const_var_mes, va as rend_const_var_ano, cast(dt as varchar) as dt_ingest from v where mes % 3 = 0""")
def _(t):
    found = B.labour_report(_labour(t, "ocupados", 1), _labour(t, "rendimento", 3))
    return found.withColumn("dt_ingest", F.to_date("dt_ingest").cast("string"))


def _costs(t):
    long = _by_code(t, list(B.PRICES), F.date_format("o_orderdate", "yyyyMM"))
    return B.construction_costs(long.select(F.col("code").alias("variavel_id"), "periodo", F.translate(F.format_number(F.col("n") * 100, 0), ",", ".").alias("valor")))


def _cost_index(t):
    return B.cost_index(_monthly(t).select(
        F.date_format("m", "MM/yyyy").alias("mes"), F.col("n").cast("string").alias("indice"), *[(F.col("k") % j).cast("string").alias(c) for j, c in ((7, "var_mes"), (11, "var_ano"), (13, "var_12_meses"))]
    ))


@kit.query("p9_construction_prices", f"""
with {_code_sql(list(B.PRICES), _MONTH)}, {_M},
s as (select cast(sum(n) filter (code = '48' and periodo = '199712') as double) as a, cast(sum(n) filter (code = '1196' and periodo = '199712') as double) as b, cast(sum(n) filter (code = '1198' and periodo = '199712') as double) as c,
  cast(sum(n) filter (code = '1198' and periodo = '199612') as double) as d from l),
i as (select cast(max(case when m = date '1997-12-01' then n end) as double) as e, cast(max(case when m = date '1997-12-01' then k % 7 end) as double) as f, cast(max(case when m = date '1997-12-01' then k % 13 end) as double) as g,
  cast(max(case when m = date '1996-12-01' then k % 13 end) as double) as h from m)
select a as sinapi_custo_m2_dez97, b as sinapi_var_mes_dez97, c as sinapi_var_12m_dez97, d as sinapi_var_12m_dez96, e as incc_indice_dez97, f as incc_var_mes_dez97, g as incc_var_12m_dez97, h as incc_var_12m_dez96 from s, i""")
def _(t):
    return B.construction_prices(_costs(t), _cost_index(t), ("1997-12-01", "dez97"), ("1996-12-01", "dez96"))


#: Columns of the loan tables that the reports use, in a fixed order.
_FUND = sorted({c for _, u, v, _ in B.LOAN_BANDS for c in (u, v)} - {"valor_total_calculado"} | {f"financiamento_pf_uh_pro_cotista_{b}" for b in ("faixa_1", "faixa_2", "faixa_3", "classe_media")})
_LOANS = ["sbpe_const", "sbpe_aquisicao", "sbpe_total", "sbpe_const_milhoes", "sbpe_aquisicao_milhoes", "sbpe_aq_novos_uh", "sbpe_aq_usados_uh"]


def _wide(t, columns, first=1):
    """A monthly table of whole numbers, some of them missing."""
    cell = lambda j: F.when((F.month("m") + j) % 7 != 0, F.col("n") * j + F.col("k") % (j + 2))
    return _monthly(t).select(
        F.year("m").alias("ano"), F.month("m").alias("mes"), F.quarter("m").alias("trimestre"), F.date_format("m", "yyyy-MM").alias("periodo"), *[cell(j).cast("long").alias(c) for j, c in enumerate(columns, first)]
    )


def _wide_sql(name, columns, first=1):
    cells = ", ".join(f"case when (month(m) + {j}) % 7 <> 0 then n * {j} + k % {j + 2} end as {c}" for j, c in enumerate(columns, first))
    return f"{name} as (select cast(year(m) as int) as ano, cast(month(m) as int) as mes, cast(quarter(m) as int) as trimestre, strftime(m, '%Y-%m') as periodo, {cells} from m)"


_must, _may = B.FUND_VALUES
_TOTAL = " + ".join([*_must, *[f"coalesce({c}, 0)" for c in _may]])
_FUND_SQL = f"{_M}, {_wide_sql('f0', _FUND)}, f as (select *, {_TOTAL} as valor_total_calculado from f0), {_wide_sql('a', _LOANS, 40)}"


def _fund(t):
    return B.fund_loans(_wide(t, _FUND))


def _loans(t):
    return _wide(t, _LOANS, 40)


@kit.query("p13_savings_funded_loans", f"""
with {_FUND_SQL} select *, {", ".join(f"round(({c} * 1.0 / nullif(lag({c}, {k}) over w, 0) - 1) * 100, 1) as {p}_var_{n}" for c, p in B.SAVINGS_LOANS.items() for k, n in ((1, "mes"), (12, "12m")))} from a window w as (order by ano, mes)""")
def _(t):
    return B.savings_funded_loans(_loans(t))


@kit.query("p14_fund_loans", f"with {_FUND_SQL} select * from f")
def _(t):
    return _fund(t)


@kit.query("p15_loans_by_quarter", f"""
with {_FUND_SQL}, x as (select ano, trimestre, cast(sum(financiamento_pf_uh_total_geral) as bigint) as fgts_uh from f group by 1, 2), y as (select ano, trimestre, cast(sum(sbpe_const) as bigint) as sbpe_uh from a group by 1, 2)
select * from x left join y using (ano, trimestre)""")
def _(t):
    return B.loans_by_quarter(_fund(t), _loans(t))


_PERIODS = [("4º TRI 1997", "1997-10-01", "1997-10-01"), ("3º TRI 1997", "1997-07-01", "1997-07-01"), ("4º TRI 1996", "1996-10-01", "1996-10-01"), ("12 MESES - DEZ/1997", "1997-01-01", "1997-10-01")]
_PERIOD_SQL = "p(periodo, a, b) as (values " + ", ".join(f"('{n}', {int(x[:4]) * 4 + (int(x[5:7]) + 2) // 3}, {int(y[:4]) * 4 + (int(y[5:7]) + 2) // 3})" for n, x, y in _PERIODS) + ")"


@kit.query("p15_loan_periods", f"""
with {_FUND_SQL}, {_PERIOD_SQL}, x as (select ano * 4 + trimestre as q, sum(financiamento_pf_uh_total_geral) as fgts_uh from f group by 1), y as (select ano * 4 + trimestre as q, sum(sbpe_const) as sbpe_uh from a group by 1)
select periodo, cast(sum(fgts_uh) as bigint) as fgts_uh, cast(sum(sbpe_uh) as bigint) as sbpe_uh from p left join (select * from x left join y using (q)) z on z.q between p.a and p.b group by 1""")
def _(t):
    return B.quarter_periods(B.loans_by_quarter(_fund(t), _loans(t)), ["fgts_uh", "sbpe_uh"], _PERIODS)


def _matrix_sql():
    pieces, lines = [], []
    for i, (label, used, total, shown) in enumerate(B.INCOME_BANDS, 1):
        for k, y in (("a", 1996), ("b", 1997)):
            u = f"cast(sum({used}) filter (ano = {y}) as double)" if used else "cast(null as double)"
            n = f"cast(sum({total}{f' - coalesce({used}, 0)' if used else ''}) filter (ano = {y}) as double)" if total else "cast(null as double)"
            pieces += [f"{u} as u{i}{k}", f"{n} as n{i}{k}"]
        first = (f"u{i}a", f"n{i}a") if shown else ("cast(null as double)", "cast(null as double)")
        change = lambda c: f"round(({c}b / nullif({c}a, 0) - 1) * 100, 0)"
        lines.append(f"select {i} as ordem, '{label}' as categoria, {first[0]} as uh_usadas_1996, {first[1]} as uh_novas_1996, u{i}b as uh_usadas_1997, {change(f'u{i}')} as var_usadas, n{i}b as uh_novas_1997, {change(f'n{i}')} as var_novas from s")
    return f"with {_FUND_SQL}, s as (select {', '.join(pieces)} from f) " + " union all ".join(lines)


@kit.query("p16_income_matrix", _matrix_sql())
def _(t):
    return B.income_matrix(_fund(t), (1996, 1997))


@kit.query("p16_loans_by_band", f"with {_FUND_SQL} " + " union all ".join(
    f"select {i} as ordem, '{label}' as categoria, " + ", ".join(f"cast(sum({u}) filter (ano = {y}) as double) as uh_{y}, round(sum({v}) filter (ano = {y}) / 1e9, {d}) as val_bi_{y}" for y in (1996, 1997)) + " from f"
    for i, (label, u, v, d) in enumerate(B.LOAN_BANDS, 1)))
def _(t):
    return B.loans_by_band(_fund(t), (1996, 1997))


@kit.query("p16_units_by_condition", f"""
with {_FUND_SQL}, s as (select cast(sum(u) filter (s = 'f' and ano = 1996) as double) as fux, cast(sum(n) filter (s = 'f' and ano = 1996) as double) as fnx, cast(sum(u) filter (s = 'f' and ano = 1997) as double) as fuy,
    cast(sum(n) filter (s = 'f' and ano = 1997) as double) as fny, cast(sum(u) filter (s = 'a' and ano = 1996) as double) as aux, cast(sum(n) filter (s = 'a' and ano = 1996) as double) as anx, cast(sum(u) filter (s = 'a' and ano = 1997) as double) as auy,
    cast(sum(n) filter (s = 'a' and ano = 1997) as double) as any_ from (
      select 'f' as s, ano, financiamento_pf_uh_pro_cotista_geral as u, financiamento_pf_uh_total_geral - coalesce(financiamento_pf_uh_pro_cotista_geral, 0) as n from f
      union all select 'a', ano, sbpe_aq_usados_uh, sbpe_aq_novos_uh from a) z),
l(ordem, categoria, ux, nx, uy, ny) as (select 1, 'FGTS - PF', fux, fnx, fuy, fny from s union all select 2, 'SBPE (Aquisição)', aux, anx, auy, any_ from s union all select 3, 'Total', fux + aux, fnx + anx, fuy + auy, fny + any_ from s)
select ordem, categoria, ux as uh_usadas_1996, nx as uh_novas_1996, uy as uh_usadas_1997, round((uy / nullif(ux, 0) - 1) * 100, 0) as var_usadas, ny as uh_novas_1997, round((ny / nullif(nx, 0) - 1) * 100, 0) as var_novas from l""")
def _(t):
    return B.units_by_condition(_fund(t), _loans(t), (1996, 1997))


@kit.query("p17_finance_kpis", f"""
with {_FUND_SQL},
f2 as (select {", ".join(f"cast(sum({c}) filter (ano = {y}) as double) as {n}{k}" for n, c in (("uh", "financiamento_pf_uh_total_geral"), ("val", "valor_total_calculado"), ("pcu", "financiamento_pf_uh_pro_cotista_geral"), ("pcv", "financiamento_pf_valor_pro_cotista_geral")) for k, y in (("a", 1996), ("b", 1997)))} from f),
a2 as (select {", ".join(f"cast(sum({c}) filter (ano = {y}) as double) as {n}{k}" for n, c in (("aq", "sbpe_aquisicao"), ("aqm", "sbpe_aquisicao_milhoes"), ("co", "sbpe_const"), ("com", "sbpe_const_milhoes")) for k, y in (("a", 1996), ("b", 1997)))} from a)
select uhb + coalesce(aqb, 0) as mcmv_sbpe_uh_97, round(valb / 1e9 + coalesce(aqmb, 0) / 1e3, 2) as mcmv_sbpe_val_bi_97, round(((uhb + coalesce(aqb, 0)) / nullif(uha + coalesce(aqa, 0), 0) - 1) * 100, 0) as mcmv_sbpe_var_uh,
  round(((valb / 1e9 + coalesce(aqmb, 0) / 1e3) / nullif(vala / 1e9 + coalesce(aqma, 0) / 1e3, 0) - 1) * 100, 0) as mcmv_sbpe_var_val, cob as sbpe_const_uh_97, round(comb / 1e3, 2) as sbpe_const_bi_97,
  round((cob / nullif(coa, 0) - 1) * 100, 0) as sbpe_const_var_uh, round((comb / nullif(coma, 0) - 1) * 100, 0) as sbpe_const_var_bi, pcub as pro_cotista_uh_97, round(pcvb / 1e9, 2) as pro_cotista_val_bi_97,
  round((pcub / nullif(pcua, 0) - 1) * 100, 0) as pro_cotista_var_uh, round((pcvb / nullif(pcva, 0) - 1) * 100, 0) as pro_cotista_var_val, uhb as fin_pf_uh_97, round(valb / 1e9, 2) as fin_pf_val_bi_97,
  round((uhb / nullif(uha, 0) - 1) * 100, 0) as fin_pf_var_uh, round((valb / nullif(vala, 0) - 1) * 100, 0) as fin_pf_var_val from f2, a2""")
def _(t):
    return B.finance_kpis(_fund(t), _loans(t), (1996, 1997))


_CBIC = [f"cbic_{w}_{c}" for w in ("lancamentos", "vendas") for c in ("total", "mcmv", "demais", *[f"{p}{r}" for p in ("regiao_", "mcmv_regiao_", "mcmv_perc_regiao_") for r in B.LAUNCH_REGIONS.values()])]


def _cbic(t):
    """The monthly table as if its rows of quarter ends were the quarters."""
    return _wide(t, _CBIC).where("mes % 3 = 0")


for _what in ("lancamentos", "vendas"):

    @kit.query(f"p19_{_what}_national", f"""
with {_M}, {_wide_sql("w", _CBIC)}, {_PERIOD_SQL} select periodo, {", ".join(f"cast(sum(cbic_{_what}_{c}) as bigint) as {c}" for c in ("total", "mcmv", "demais"))}
from p left join (select * exclude (periodo), ano * 4 + trimestre as q from w where mes % 3 = 0) z on q between p.a and p.b group by 1""")
    def _(t, what=_what):
        return B.launches_national(_cbic(t), what, _PERIODS)

    @kit.query(f"p19_{_what}_by_region", f"with {_M}, {_wide_sql('w', _CBIC)}, z as (select *, ano * 4 + trimestre as q from w where mes % 3 = 0) " + " union all ".join(
        f"select '{r}' as regiao, max(cbic_{_what}_regiao_{c}) filter (q = 7992) as total, max(cbic_{_what}_mcmv_regiao_{c}) filter (q = 7992) as mcmv, "
        + ", ".join(f"cast(max(cbic_{_what}_mcmv_perc_regiao_{c}) filter (q = {q}) as double) as perc_mcmv_{n}" for q, n in ((7992, "4t97"), (7991, "3t97"), (7988, "4t96"))) + " from z" for r, c in B.LAUNCH_REGIONS.items()))
    def _(t, what=_what):
        return B.launches_by_region(_cbic(t), what, [(1997, 4), (1997, 3), (1996, 4)])


@kit.query("p20_market_indices", f"""
with {_M}, {_RENT}, v as (select m, n + 0.25 as t, cast(k % 900 + 1 as double) as s, cast(n % 50 as double) as mm, cast(n % 70 as double) as my from m),
a as (select {", ".join(f"max({c}) filter (m = date '{d}') as {c}_{k}" for c in ("t", "s", "mm", "my") for k, d in (("d0", "1997-12-01"), ("n0", "1997-11-01"), ("d1", "1996-12-01"), ("d2", "1995-12-01"), ("d3", "1994-12-01")))} from v),
b as (select {", ".join(f"max({c}) filter (data_referencia = date '{d}') as {n}_{k}" for c, n in (("var_mensal", "r"), ("var_ano", "ry")) for k, d in (("d0", "1997-12-01"), ("d1", "1996-12-01"), ("d2", "1995-12-01")))} from rent)
select 'DEZ 97 vs. NOV 97' as periodo, round((s_d0 / s_n0 - 1) * 100, 1) as imob_var, round(r_d0 * 100, 2) as fipezap_var, round((t_d0 / t_n0 - 1) * 100, 2) as icst_var, mm_d0 as abramat_var from a, b
union all select 'DEZ 97 vs. DEZ 96', round((s_d0 / s_d1 - 1) * 100, 1), round(((1 + r_d0) / (1 + r_d1) - 1) * 100, 2), round((t_d0 / t_d2 - 1) * 100, 2), my_d0 from a, b
union all select 'JAN-DEZ/97', round((s_d0 / s_d1 - 1) * 100, 1), round(ry_d0 * 100, 2), round((t_d0 / t_d2 - 1) * 100, 2), my_d0 from a, b
union all select 'JAN-DEZ/96', round((s_d1 / s_d2 - 1) * 100, 1), round(ry_d2 * 100, 2), round((t_d3 / t_d2 - 1) * 100, 2), my_d2 from a, b""")
def _(t):
    m = _monthly(t)
    stock = m.select(F.col("m").alias("data_referencia"), (F.col("k") % 900 + 1).cast("double").alias("close"))
    materials = m.select(F.col("m").alias("data_referencia"), (F.col("n") % 50).cast("double").alias("var_mes"), (F.col("n") % 70).cast("double").alias("var_12_meses"))
    return B.market_indices(stock, _rent(t), _confidence(t), materials, 1997)


@kit.query("p21_ticket_against_cost", f"""
with {_M}, i as (select m, cast(n as double) as i, round((n * 1.0 / lag(n, 3) over (order by m) - 1) * 100, 2) as v from m),
q as (select cast(year(m) as int) as ano, cast(quarter(m) as int) as trimestre, max(case when month(m) % 3 = 0 then v end) as v, max(case when month(m) % 3 = 0 then i end) as i from i group by 1, 2),
o as (select cast(year(o_orderdate) as int) as ano, cast(quarter(o_orderdate) as int) as trimestre, o_orderkey % 3 as e, cast(count(*) as double) as c, cast(max(o_orderkey) % 977 as double) as d from orders group by 1, 2, 3),
w as (select ano, trimestre, {", ".join(f"max({c}) filter (e = {e}) as {p}_{n}" for c, n in (("c", "var_tri"), ("d", "acum_4t20")) for e, p in enumerate(("mrv", "dir", "ten")))} from o group by 1, 2)
select w.*, round(q.v, 1) as incc_var_tri, round((q.i / (select i from i where m = date '1993-12-01') - 1) * 100, 1) as incc_acum_4t20 from w left join q using (ano, trimestre) where ano * 4 + trimestre >= 1996 * 4 + 4""")
def _(t):
    name = F.get(F.array(*map(F.lit, B.TICKETS)), (F.col("o_orderkey") % 3).cast("int"))
    tickets = t("orders").groupBy(name.alias("empresa"), F.year("o_orderdate").alias("ano"), F.quarter("o_orderdate").alias("trimestre")).agg(
        F.count(F.lit(1)).cast("double").alias("var_tri"), (F.max("o_orderkey") % 977).cast("double").alias("acum")
    )
    return B.ticket_against_cost(tickets, _cost_index(t), "1993-12-01", (1996, 4))


@kit.query("p22_staged_reads", f"""
with {_M} {" union all ".join(f"select '{model}' as model, m as data, n + {j} as valor from m" for j, model in enumerate(B.STAGED_READS))}""", dates="data")
def _(t):
    staging = f"{checkpoint_root(t.spark).rstrip('/')}/marajo-staging-{uuid.uuid4().hex}"
    held = stash(_monthly(t), "series")
    for j, path in enumerate(B.STAGED_READS.values()):
        held.select(F.col("m").alias("data"), (F.col("n") + j).alias("valor"), F.lit("?").alias("not_read")).coalesce(1).write.parquet(f"{staging}/{path}.parquet")
    reads = [B.staged_series(t.spark, staging, model, ["data", "valor"]).select(F.lit(model).alias("model"), "data", "valor") for model in B.STAGED_READS]
    return reduce(DataFrame.unionByName, reads)


@kit.query("p22_table_reads", f"""
with {_M} {" union all ".join(f"select '{model}' as model, m as data, n * {j} as valor from m" for j, model in enumerate(B.TABLE_READS, 1))}""", dates="data")
def _(t):
    held = stash(_monthly(t), "series")
    reads = []
    for j, (model, table) in enumerate(B.TABLE_READS.items(), 1):
        name = f"{table}_{uuid.uuid4().hex}"  # the reports' own names may be taken in this session
        held.select(F.col("m").alias("data"), (F.col("n") * j).alias("valor")).createTempView(name)
        reads.append(S.read_table(t.spark, name).select(F.lit(model).alias("model"), "data", "valor"))
        t.spark.catalog.dropTempView(name)
    return reduce(DataFrame.unionByName, reads)


def _stacked(frames, ids):
    """Tables of different columns as rows of table, ids, column and value."""
    def long(name, df):
        values = [c for c in df.columns if c not in ids]
        cells = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).cast("double").alias("valor")) for c in values])
        return df.select(F.lit(name).alias("tabela"), *ids, F.explode(cells).alias("x")).select("tabela", *ids, "x.*")

    return reduce(DataFrame.unionByName, [long(n, df) for n, df in frames.items()])


_MONTHLY_COLUMNS = sorted({c for cols, require in B.MONTHLY_SLICES.values() for c in (*cols, *require)})


@kit.query("p23_monthly_slices", f"with {_M}, {_wide_sql('w', _MONTHLY_COLUMNS)} " + " union all ".join(
    f"select '{name}' as tabela, periodo, ano, mes, make_date(ano, mes, 1) as data_referencia, '{c}' as coluna, cast({c} as double) as valor from w where coalesce({', '.join(require)}) is not null"
    for name, (cols, require) in B.MONTHLY_SLICES.items() for c in cols), dates="data_referencia")
def _(t):
    wide = stash(_wide(t, _MONTHLY_COLUMNS), "monthly")
    return _stacked({n: B.monthly_slice(wide, n) for n in B.MONTHLY_SLICES}, ["periodo", "ano", "mes", "data_referencia"])


_QUARTERLY_COLUMNS = sorted({c for cols in B.QUARTERLY_SLICES.values() for c in cols.values()})


@kit.query("p24_quarterly_slices", f"with {_M}, {_wide_sql('w', _QUARTERLY_COLUMNS)} " + " union all ".join(
    f"select '{name}' as tabela, periodo, ano, trimestre || 'T' || ano as trimestre, make_date(ano, trimestre * 3 - 2, 1) as data_referencia, '{n}' as coluna, cast({c} as double) as valor from w where mes % 3 = 0"
    for name, cols in B.QUARTERLY_SLICES.items() for n, c in cols.items()), dates="data_referencia")
def _(t):
    wide = _wide(t, _QUARTERLY_COLUMNS).where("mes % 3 = 0").withColumn("trimestre", F.concat(F.col("trimestre").cast("string"), F.lit("T"), F.col("ano").cast("string")))
    wide = stash(wide, "quarterly")
    return _stacked({n: B.quarterly_slice(wide, n) for n in B.QUARTERLY_SLICES}, ["periodo", "ano", "trimestre", "data_referencia"])


_DIRECT = {name: [c for c in values.values() if c not in ("data", "data_referencia", "ano", "mes")] for name, (_, values) in B.DIRECT_SERIES.items()}


@kit.query("p25_direct_series", f"with {_M} " + " union all ".join(
    f"select '{name}' as tabela, strftime(m, '%Y-%m-%d') as data, '{next(n for n, x in B.DIRECT_SERIES[name][1].items() if x == c)}' as coluna, cast(n * {j} as double) as valor from m" for name, cols in _DIRECT.items() for j, c in enumerate(cols, 1)))
def _(t):
    held = stash(_monthly(t), "series")
    frames = {}
    for name, cols in _DIRECT.items():
        own = held.select(
            F.date_format("m", "MM/yyyy").alias("mes"), F.year("m").alias("ano"), F.col("m").alias("data"), F.col("m").alias("data_referencia"), *[(F.col("n") * j).alias(c) for j, c in enumerate(cols, 1)]
        )
        found = B.direct_series(own, name)
        at = F.to_date(F.concat(F.lit("01/"), "mes"), "dd/MM/yyyy") if "mes" in found.columns else F.col("data" if "data" in found.columns else "data_referencia")
        frames[name] = found.select(at.cast("string").alias("at"), *[c for c in found.columns if c not in ("data", "data_referencia", "ano", "mes")]).withColumnRenamed("at", "data")
    return _stacked(frames, ["data"])


@kit.query("p26_pivots", "with " + ", ".join(_code_sql(list(codes), _MONTH).replace("l as", f"l{i} as", 1) for i, (_, codes) in enumerate(B.PIVOTS.values())) + " " + " union all ".join(
    f"select '{name}' as tabela, periodo, '{column}' as coluna, cast(max(case when code = '{code}' then n end) as double) as valor from l{i} group by 1, 2, 3"
    for i, (name, (_, codes)) in enumerate(B.PIVOTS.items()) for code, column in codes.items()))
def _(t):
    frames = {name: B.pivoted_series(_by_code(t, list(codes), F.date_format("o_orderdate", "yyyyMM"), text=False).withColumnRenamed("code", column), name) for name, (column, codes) in B.PIVOTS.items()}
    return _stacked(frames, ["periodo"])


@kit.query("p27_output_and_retail", f"""
with {_code_sql(list(B.OUTPUT), _MONTH)}, r as (select {_MONTH} as periodo, ['11708', '11710', '11711'][o_orderkey % 3 + 1] as code, count(*) as n from orders where o_custkey % 2 = 0 and year(o_orderdate) > 1993 group by 1, 2),
a as (select periodo, {", ".join(f"cast(max(case when code = '{c}' then n end) as double) as {n}" for c, n in B.OUTPUT.items())} from l where left(periodo, 4) < '1998' group by 1),
b as (select periodo, {", ".join(f"cast(max(case when code = '{c}' then n end) as double) as {n}" for c, n in B.RETAIL.items())} from r group by 1)
select periodo, strptime(periodo || '01', '%Y%m%d')::date as data_referencia, * exclude (periodo) from a full join b using (periodo)""", dates="data_referencia")
def _(t):
    period = F.date_format("o_orderdate", "yyyyMM")
    output = _by_code(t, list(B.OUTPUT), period, text=False).withColumnRenamed("code", "variavel_id").where("periodo < '1998'")
    code = F.get(F.array(*map(F.lit, B.RETAIL)), (F.col("o_orderkey") % 3).cast("int"))
    retail = t("orders").where("year(o_orderdate) > 1993").groupBy(period.alias("periodo"), code.alias("variavel_id"), F.when(F.col("o_custkey") % 2 == 0, "56734").otherwise("1").alias("categoria_id"))
    return B.output_and_retail(output, retail.agg(F.count(F.lit(1)).cast("double").alias("valor")))


def _company_columns(prefix):
    own = [f"{prefix}_{m}" for m in ("lancamentos", "vendas")]
    changes = ["tri_anterior", "mesmo_tri_ano_anterior"]
    last = "acumulado_mesmo_periodo_ano_anterior"
    return [*own, *[f"{prefix}_var_{m}_{v}" for m in ("lancamentos", "vendas") for v in changes], f"{prefix}_var_lancamento_{last}", f"{prefix}_var_vendas_{last}"]


_COMPANY = [c for p in B.COMPANY_PREFIXES.values() for c in _company_columns(p)]


@kit.query("p28_company_rows", f"with {_M}, {_wide_sql('w', _COMPANY)}, z as (" + " union all ".join(
    f"select periodo, ano, cast(trimestre as varchar) as trimestre, '{name}' as empresa, make_date(ano, trimestre * 3 - 2, 1) as data_referencia, "
    + ", ".join(f"{p}_{m} as {m}, {p}_var_{m}_tri_anterior as var_{m}_tri_anterior, {p}_var_{m}_mesmo_tri_ano_anterior as var_{m}_mesmo_tri_ano_anterior, {p}_var_{one}_acumulado_mesmo_periodo_ano_anterior as var_{m}_acumulado_periodo_ano_anterior"
                for m, one in (("lancamentos", "lancamento"), ("vendas", "vendas")))
    + " from w where mes % 3 = 0" for name, p in B.COMPANY_PREFIXES.items()) + ") select * from z where lancamentos is not null or vendas is not null", dates="data_referencia")
def _(t):
    return B.company_rows(_wide(t, _COMPANY).where("mes % 3 = 0").withColumn("trimestre", F.col("trimestre").cast("string")).drop("mes"))

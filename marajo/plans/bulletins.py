"""Bulletin pipelines: raw statistical series to report tables, each a composition of the library's operators.

Functions take text-typed or typed frames with the column names given in their docstrings and return one table.
Series windows have no partition because a series has one row a month; give ``partition`` where series are many.
Dates and periods of a report are parameters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marajo.functions import cleaning as C
from marajo.operators import tables as T

# --- quarterly bulletin -------------------------------------------------------------------------------------


#: Amounts of the savings series.
SAVINGS = ["deposito", "retirada", "captacao_liquida_valor", "captacao_liquida_pct", "rendimento", "saldo"]


def savings(raw: DataFrame) -> DataFrame:
    """P1. Monthly savings series (a day and :data:`SAVINGS`, text) typed, with net deposits in billions and over twelve months."""
    base = raw.select(F.col("data_referencia").cast("date").alias("data_referencia"), *[F.col(c).try_cast("double").alias(c) for c in SAVINGS])
    base = base.withColumn("captacao_liquida_bi", C.scale_round("captacao_liquida_valor", 1e3))
    return T.rolling_sum(base, "captacao_liquida_valor", "data_referencia", 12, name="captacao_acum_12m")


def savings_periods(series: DataFrame, periods: Sequence[tuple[str, str, str]]) -> DataFrame:
    """P1 gold. ``ordem, periodo, cap_liq_bi`` of the output of :func:`savings`; ``periods`` are label, first and last month."""
    found = T.period_table(series, "data_referencia", ["captacao_liquida_valor"], periods)
    return found.select(F.col("position").alias("ordem"), F.col("period").alias("periodo"), C.scale_round("captacao_liquida_valor", 1e3).alias("cap_liq_bi"))


#: Credit series by the column they report to.
CREDIT_SERIES = {"pf_total": "total", "pf_mercado": "market", "pf_regulado": "regulated", "pj_total": "company_total", "pj_mercado": "company_market", "pj_regulado": "company_regulated"}


def mortgage_credit(raw: DataFrame, mapping: Mapping[str, str] = CREDIT_SERIES, periods: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """P2, P26. ``tipo, data (dd/MM/yyyy), valor`` to one column per series and month, or to the period table.

    The real date is parsed; a month lacking a series has a null there.
    """
    day = F.trunc(C.parse_date_br("data"), "month")
    long = raw.select("tipo", day.alias("data_referencia"), C.parse_numeric("valor", "double").alias("valor")).where("data_referencia is not null")
    wide = T.pivot_codes(long, "data_referencia", "tipo", "valor", mapping)
    return T.period_table(wide, "data_referencia", list(mapping.values()), periods) if periods else wide


def confidence(raw: DataFrame) -> DataFrame:
    """P3. ``mes (MM/yyyy)`` and the index with and without seasonal adjustment, to numbers with changes on month and year."""
    names = ["icst_com_ajuste_sazonal", "icst_sem_ajuste_sazonal"]
    base = raw.select(C.period_to_date("mes", "mm/yyyy").alias("data_referencia"), *[C.parse_numeric(c, "double").alias(c) for c in names]).where("data_referencia is not null")
    for k, name in ((1, "var_mes"), (12, "var_12_meses")):
        base = T.pct_change(base, names[1], "data_referencia", k, digits=2, name=name)
    return base


def cost_index(raw: DataFrame) -> DataFrame:
    """P4. ``mes (MM/yyyy), indice, var_mes, var_ano, var_12_meses`` with sentinels to the index with its quarterly change."""
    number = lambda c: C.parse_numeric(C.null_sentinels(c), "double").alias(c)
    base = raw.select(C.period_to_date("mes", "mm/yyyy").alias("data_referencia"), *[number(c) for c in ("indice", "var_mes", "var_ano", "var_12_meses")])
    base = base.where("data_referencia is not null").withColumns({"ano": F.year("data_referencia"), "trimestre": F.quarter("data_referencia")})
    return T.pct_change(base, "indice", "data_referencia", 3, digits=2, name="var_tri")


def rent_index(raw: DataFrame) -> DataFrame:
    """P5. ``data_referencia`` and two text rates of residential rents, with the ratio to the monthly rate of twelve
    months before, in percent."""
    rate = lambda c: F.col(f"imoveis_residenciais_locacao_{c}_total").try_cast("double").alias(c)
    base = raw.select(F.col("data_referencia").cast("date").alias("data_referencia"), rate("var_mensal"), rate("var_ano"))
    found = T.ratio_of_rates(base, "var_mensal", "data_referencia", 12, name="_ratio")
    return found.withColumn("var_12_meses_calc", F.round(F.col("_ratio") * 100, 2)).drop("_ratio")


#: Indicators of the GDP report by variable.
GDP_INDICATORS = {"6564": "Trim./Trim. Imediatamente Anterior", "6563": "Acumulada ao Longo do Ano", "6562": "Acum. Últimos 4 Trimestres"}


def gdp(raw: DataFrame, periods: Mapping[str, str], indicators: Mapping[str, str] = GDP_INDICATORS) -> DataFrame:
    """P6. Long quarterly series (``variavel_id, periodo, valor`` in tenths) to a row per indicator and a column per
    period (period to column name), the highest variable first."""
    rows = raw.where(F.col("variavel_id").isin(*indicators)).select("variavel_id", "periodo", (C.num_br("valor") / 10).alias("valor"))
    wide = T.pivot_codes(rows, "variavel_id", "periodo", "valor", periods)
    return wide.orderBy(F.desc("variavel_id")).select(C.decode("variavel_id", indicators, None).alias("indicador"), *[F.round(c, 1).alias(c) for c in periods.values()])


def monthly_volume(raw: DataFrame) -> DataFrame:
    """P7. Long series of output or retail volume: typed, dated, sentinels null, names in capitals."""
    return raw.select(
        "variavel_id", C.upper_trim("variavel_nome").alias("variavel_nome"), C.upper_trim("categoria_nome").alias("categoria_nome"),
        C.period_to_date("periodo").alias("data_referencia"), C.parse_numeric(C.null_sentinels("valor"), "double").alias("valor"),
    )


#: Categories of the labour survey: construction, and all activities.
LABOUR = ("47949", "47946")


def labour_survey(raw: DataFrame, name: str, categories: tuple[str, str] = LABOUR) -> DataFrame:
    """P8 silver. ``periodo, categoria_id, valor, dt_ingest`` to ``<name>_construcao`` and ``<name>_total`` by period, with
    changes on one and twelve periods before."""
    of = lambda code: F.max(F.when(F.col("categoria_id") == code, F.col("valor").try_cast("double")))
    wide = raw.groupBy("periodo").agg(of(categories[0]).alias(f"{name}_construcao"), of(categories[1]).alias(f"{name}_total"), F.max("dt_ingest").alias("dt_ingest"))
    wide = wide.withColumns({"data_referencia": C.period_to_date("periodo"), "ano": C.year_of_period("periodo"), "mes": C.month_of_period("periodo")})
    wide = wide.withColumn("trimestre", C.quarter_of("mes"))
    wide = T.pct_change(wide, f"{name}_construcao", "periodo", 1, name="var_mes")
    return T.pct_change(wide, f"{name}_construcao", "periodo", 12, name="var_ano")


def labour_report(occupied: DataFrame, income: DataFrame) -> DataFrame:
    """P8 gold. Quarter-end months of both surveys (``ocupados``, ``rendimento``) side by side under the later stamp."""
    names = {"rendimento_construcao": "rend_const_rs", "rendimento_total": "rend_total_rs", "var_mes": "rend_const_var_mes", "var_ano": "rend_const_var_ano", "dt_ingest": "_r"}
    right = T.quarter_end_months(income, "mes").select("periodo", *[F.col(c).alias(n) for c, n in names.items()])
    both = T.enrich(T.quarter_end_months(occupied, "mes"), [(right, "periodo")], checked=False)
    return both.orderBy("ano", "trimestre").select(
        "ano", "trimestre", "periodo", F.col("ocupados_construcao").alias("pnad_const_milhares"), F.col("ocupados_total").alias("pnad_total_milhares"),
        F.col("var_mes").alias("pnad_const_var_mes"), F.col("var_ano").alias("pnad_const_var_ano"), *[n for n in names.values() if n != "_r"], T.latest_stamp("dt_ingest", "_r").alias("dt_ingest"),
    )


#: Measures of construction prices by variable.
PRICES = {"48": "custo_m2", "1196": "var_mes", "1197": "var_ano", "1198": "var_12m"}


def construction_costs(raw: DataFrame, variables: Mapping[str, str] = PRICES) -> DataFrame:
    """P9 silver. Long series by ``variavel_id`` in hundredths to a column per measure and month."""
    rows = raw.select(C.period_to_date("periodo").alias("data_referencia"), "variavel_id", (C.num_br("valor") / 100).alias("valor"))
    return T.pivot_codes(rows.where("data_referencia is not null"), "data_referencia", "variavel_id", "valor", variables)


def construction_prices(costs: DataFrame, index: DataFrame, now: tuple[str, str], before: tuple[str, str]) -> DataFrame:
    """P9 gold. One row of both cost series (:func:`construction_costs`, :func:`cost_index`) in the month ``now`` (month and
    suffix of its columns), and their yearly change also in the month ``before``."""
    def at(df: DataFrame, prefix: str, now_cols: Sequence[str], year: str) -> DataFrame:
        value = lambda c, m, digits: F.round(F.max(F.when(F.col("data_referencia") == F.lit(m).cast("date"), F.col(c))), digits)
        own = [value(c, now[0], d).alias(f"{prefix}_{n}_{now[1]}") for c, n, d in now_cols]
        return df.agg(*own, value(year, before[0], 2).alias(f"{prefix}_var_12m_{before[1]}"))

    sinapi = at(costs, "sinapi", [("custo_m2", "custo_m2", 1), ("var_mes", "var_mes", 2), ("var_12m", "var_12m", 2)], "var_12m")
    incc = at(index, "incc", [("indice", "indice", 1), ("var_mes", "var_mes", 2), ("var_12_meses", "var_12m", 2)], "var_12_meses")
    return T.cross_scalars(sinapi, incc)


def stock_index(quotes: DataFrame, symbol: str = "IMOB.SA") -> DataFrame:
    """P10. Daily quotes (``symbol, data_pregao, close``) to month closes with changes on month, year and series start."""
    rows = quotes.where(F.col("symbol") == symbol).select(F.col("data_pregao").cast("date").alias("data_pregao"), C.parse_numeric("close", "double").alias("close"))
    base = T.period_close(rows, [], "data_pregao", "close").withColumnRenamed("period", "data_referencia")
    for k, name in ((1, "var_mes"), (12, "var_12_meses")):
        base = T.pct_change(base, "close", "data_referencia", k, name=name)
    return T.change_since_start(base, "close", "data_referencia").withColumnRenamed("close_since_start", "var_acum_serie")


def jobs(monthly: DataFrame) -> DataFrame:
    """P11. ``ano, mes, saldo, estoque`` by month to quarters: net jobs, stock, changes, and both accumulated over the year."""
    base = monthly.withColumn("trimestre", C.quarter_of("mes"))
    quarters = base.groupBy("ano", "trimestre").agg(
        F.min("mes").alias("mes_ini"), F.max("mes").alias("mes_fim"), F.sum("saldo").alias("saldo_tri"), F.max("estoque").alias("estoque_fim_tri")
    )
    order = quarters.withColumn("_t", F.col("ano") * 4 + F.col("trimestre"))
    order = T.pct_change(order, "saldo_tri", "_t", 1, digits=0, name="saldo_var_tri")
    order = T.pct_change(order, "estoque_fim_tri", "_t", 4, digits=0, name="estoque_var_ano").drop("_t")
    order = T.ytd(order, "saldo_tri", "ano", "trimestre").drop("saldo_tri_ytd_max")
    return T.ytd(order, "estoque_fim_tri", "ano", "trimestre").drop("estoque_fim_tri_ytd").orderBy("ano", "trimestre")


#: Fixed report names of the lenders, in report order; every other lender falls to the last.
LENDERS = {"CAIXA": "CEF (CAIXA)", "ITAÚ UNIBANCO": "ITAU", "BRADESCO": "BRADESCO", "SANTANDER": "SANTANDER", "BRB": "BRB", "BANCO DO BRASIL": "BB (BANCO DO BRASIL)"}
LENDER_ORDER = ["TOTAL", *LENDERS.values(), "DEMAIS"]


def loans_by_lender(raw: DataFrame, lenders: Mapping[str, str] = LENDERS) -> DataFrame:
    """P12. ``ano, mes, agente, posicao_ano_rs_milhoes, posicao_ano_unidades`` to value (billions) and units by lender
    and in total, shares of the total, and change on the same month of the year before."""
    grouped = raw.select("ano", "mes", C.bucket("agente", {v: [k] for k, v in lenders.items()}, "DEMAIS").alias("banco"), F.col("posicao_ano_rs_milhoes").alias("valor"), F.col("posicao_ano_unidades").alias("uh"))
    total = T.with_total(grouped, ["ano", "mes"], "banco", ["valor", "uh"]).withColumn("valor_bi", C.scale_round("valor", 1e3)).withColumn("_v", F.col("valor") / 1000.0)
    shares = T.share_of_total(total, ["ano", "mes"], "banco", ["_v", "uh"])
    prior = T.join_prior(shares, ["banco", "mes"], "ano", ["valor_bi", "uh"])
    order = ["TOTAL", *lenders.values(), "DEMAIS"]
    return prior.select(
        "ano", "mes", "banco", "valor_bi", F.col("_v_share").alias("perc_valor"), T.ratio_change(F.col("valor_bi"), F.col("valor_bi_prior"), 0).alias("var_ano_valor"),
        "uh", F.col("uh_share").alias("perc_uh"), T.ratio_change(F.col("uh"), F.col("uh_prior"), 0).alias("var_ano_uh"), (T.rank_of("banco", order) - 1).alias("ordem"),
    ).orderBy("ano", "mes", "ordem")


#: Units whose changes the savings-funded loans report: column to prefix.
SAVINGS_LOANS = {"sbpe_const": "sbpe_const", "sbpe_aquisicao": "sbpe_aq", "sbpe_total": "sbpe_total"}


def savings_funded_loans(monthly: DataFrame, units: Mapping[str, str] = SAVINGS_LOANS) -> DataFrame:
    """P13. A monthly table (``ano, mes``) with the changes of each unit count on the month and the year before."""
    out = monthly.withColumn("_t", C.month_start("ano", "mes"))
    for c, prefix in units.items():
        out = T.pct_change(T.pct_change(out, c, "_t", 1, name=f"{prefix}_var_mes"), c, "_t", 12, name=f"{prefix}_var_12m")
    return out.drop("_t")


_PF = "financiamento_pf_"
#: Values that make up the fund's total; a null in one of the first two makes it null, in the others it counts as 0.
FUND_VALUES = (
    [f"{_PF}valor_total_faixa_1", f"{_PF}valor_total_faixa_2"],
    [f"{_PF}valor_faixa_3_sem_fundo_social", f"{_PF}valor_faixa_3_fundo_social", f"{_PF}valor_total_classe_media", f"{_PF}valor_fora_mcmv"],
)


def fund_loans(monthly: DataFrame, values: tuple[Sequence[str], Sequence[str]] = FUND_VALUES) -> DataFrame:
    """P14. The fund's monthly loans with ``valor_total_calculado``."""
    must, may = values
    return monthly.withColumn("valor_total_calculado", sum((F.col(c) for c in must), F.lit(0)) + C.sum_components(*may))


def loans_by_quarter(fund: DataFrame, savings_loans: DataFrame) -> DataFrame:
    """P15 silver. Quarterly units of the fund's and savings-funded loans side by side."""
    by = lambda df, c, name: df.groupBy("ano", "trimestre").agg(F.sum(c).alias(name))
    return T.enrich(by(fund, f"{_PF}uh_total_geral", "fgts_uh"), [(by(savings_loans, "sbpe_const", "sbpe_uh"), ["ano", "trimestre"])], checked=False)


def quarter_periods(quarters: DataFrame, measures: Sequence[str], periods: Sequence[tuple[str, str, str]]) -> DataFrame:
    """P15 gold, P19. Quarterly measures (``ano, trimestre``) as the table ``periodo`` and sums; ``periods`` are label and
    the first days of the first and last quarter."""
    dated = quarters.withColumn("inicio", F.make_date("ano", F.col("trimestre") * 3 - 2, F.lit(1)))
    return T.period_table(dated, "inicio", measures, periods).orderBy("position").select(F.col("period").alias("periodo"), *measures)


#: Income bands of the unit matrix: label, used and all units, whether the first year is shown.
INCOME_BANDS = [
    ("FAIXA 1", f"{_PF}uh_pro_cotista_faixa_1", f"{_PF}uh_total_faixa_1", True),
    ("FAIXA 2", f"{_PF}uh_pro_cotista_faixa_2", f"{_PF}uh_total_faixa_2", True),
    ("FAIXA 3", f"{_PF}uh_pro_cotista_faixa_3", f"{_PF}uh_faixa_3_sem_fundo_social", True),
    ("FAIXA 3 FS", None, f"{_PF}uh_faixa_3_fundo_social", False),
    ("FAIXA CLASSE MÉDIA", f"{_PF}uh_pro_cotista_classe_media", f"{_PF}uh_total_classe_media", False),
    ("FORA MCMV", f"{_PF}uh_fora_mcmv", None, True),
    ("TOTAL", f"{_PF}uh_pro_cotista_geral", f"{_PF}uh_total_geral", True),
]


def income_matrix(fund: DataFrame, years: tuple[int, int], bands: Sequence[tuple[str, str | None, str | None, bool]] = INCOME_BANDS) -> DataFrame:
    """P16. Used and new units by income band in two years; new is all less used."""
    found = T.year_matrix(fund, "ano", years, {label: (total, used) for label, used, total, _ in bands})
    hidden = [label for label, _, _, shown in bands if not shown]
    first = lambda c: F.when(~F.col("category").isin(hidden), F.col(c)) if hidden else F.col(c)
    a, b = years
    return found.orderBy("position").select(
        F.col("position").alias("ordem"), F.col("category").alias("categoria"), first("used_a").alias(f"uh_usadas_{a}"), first("new_a").alias(f"uh_novas_{a}"),
        F.col("used_b").alias(f"uh_usadas_{b}"), F.col("used_change").alias("var_usadas"), F.col("new_b").alias(f"uh_novas_{b}"), F.col("new_change").alias("var_novas"),
    )


#: Bands of the loans table: label, units, value, digits of the billions.
LOAN_BANDS = [
    ("Faixa 1", f"{_PF}uh_total_faixa_1", f"{_PF}valor_total_faixa_1", 2), ("Faixa 2", f"{_PF}uh_total_faixa_2", f"{_PF}valor_total_faixa_2", 2),
    ("Faixa 3", f"{_PF}uh_faixa_3_sem_fundo_social", f"{_PF}valor_faixa_3_sem_fundo_social", 2), ("Pró-Cotista", f"{_PF}uh_pro_cotista_geral", f"{_PF}valor_pro_cotista_geral", 2),
    (" Faixa 1", f"{_PF}uh_pro_cotista_faixa_1", f"{_PF}valor_pro_cotista_faixa_1", 3), (" Faixa 2", f"{_PF}uh_pro_cotista_faixa_2", f"{_PF}valor_pro_cotista_faixa_2", 3),
    (" Faixa 3", f"{_PF}uh_pro_cotista_faixa_3", f"{_PF}valor_pro_cotista_faixa_3", 3), (" Faixa Classe Média", f"{_PF}uh_pro_cotista_classe_media", f"{_PF}valor_pro_cotista_classe_media", 3),
    (" Fora MCMV", f"{_PF}uh_fora_mcmv", f"{_PF}valor_fora_mcmv", 2), ("Faixa 3 Fundo Social", f"{_PF}uh_faixa_3_fundo_social", f"{_PF}valor_faixa_3_fundo_social", 2),
    ("Faixa Classe Média", f"{_PF}uh_total_classe_media", f"{_PF}valor_total_classe_media", 2), ("TOTAL", f"{_PF}uh_total_geral", "valor_total_calculado", 2),
]


def _year_sums(df: DataFrame, year: int, columns: Sequence[str], suffix: str) -> list[Column]:
    return [F.sum(F.when(F.col("ano") == year, F.col(c))).alias(f"{c}_{suffix}") for c in columns]


def loans_by_band(fund: DataFrame, years: tuple[int, int], bands: Sequence[tuple[str, str, str, int]] = LOAN_BANDS) -> DataFrame:
    """P16. Units and billions by band in two years, from the output of :func:`fund_loans`; one pass."""
    columns = sorted({c for _, units, value, _ in bands for c in (units, value)})
    sums = fund.where(F.col("ano").isin(*years)).agg(*[x for k, y in zip("ab", years, strict=True) for x in _year_sums(fund, y, columns, k)])
    rows = [
        F.struct(
            F.lit(i).alias("ordem"), F.lit(label).alias("categoria"),
            *[x for k, y in zip("ab", years, strict=True) for x in (
                F.col(f"{units}_{k}").cast("double").alias(f"uh_{y}"), F.round(F.col(f"{value}_{k}").cast("double") / 1e9, digits).alias(f"val_bi_{y}"))],
        )
        for i, (label, units, value, digits) in enumerate(bands, 1)
    ]
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*").orderBy("ordem")


def units_by_condition(fund: DataFrame, savings_loans: DataFrame, years: tuple[int, int]) -> DataFrame:
    """P16. Used and new units of the fund, of savings-funded purchases and of both in two years."""
    used, total = F.col(f"{_PF}uh_pro_cotista_geral"), F.col(f"{_PF}uh_total_geral")
    inside = F.col("ano").isin(*years)
    f = fund.where(inside).select("ano", used.alias("u"), (total - F.coalesce(used, F.lit(0))).alias("n"), F.lit("f").alias("s"))
    rows = f.unionByName(savings_loans.where(inside).select("ano", F.col("sbpe_aq_usados_uh").alias("u"), F.col("sbpe_aq_novos_uh").alias("n"), F.lit("a").alias("s")))
    pick = lambda s, c, y: F.sum(F.when((F.col("s") == s) & (F.col("ano") == y), F.col(c)))
    sums = rows.agg(*[pick(s, c, y).cast("double").alias(f"{s}{c}{k}") for s in "fa" for c in "un" for k, y in zip("xy", years, strict=True)])
    both = sums.withColumns({f"t{c}{k}": F.col(f"f{c}{k}") + F.col(f"a{c}{k}") for c in "un" for k in "xy"})
    x, y = years
    line = lambda i, label, s: F.struct(
        F.lit(i).alias("ordem"), F.lit(label).alias("categoria"), F.col(f"{s}ux").alias(f"uh_usadas_{x}"), F.col(f"{s}nx").alias(f"uh_novas_{x}"), F.col(f"{s}uy").alias(f"uh_usadas_{y}"),
        T.ratio_change(F.col(f"{s}uy"), F.col(f"{s}ux"), 0).alias("var_usadas"), F.col(f"{s}ny").alias(f"uh_novas_{y}"), T.ratio_change(F.col(f"{s}ny"), F.col(f"{s}nx"), 0).alias("var_novas"),
    )
    lines = F.array(line(1, "FGTS - PF", "f"), line(2, "SBPE (Aquisição)", "a"), line(3, "Total", "t"))
    return both.select(F.explode(lines).alias("r")).select("r.*").orderBy("ordem")


def finance_kpis(fund: DataFrame, savings_loans: DataFrame, years: tuple[int, int]) -> DataFrame:
    """P17. One row of units and billions of both programmes in the second year and their change on the first; ``fund``
    is the output of :func:`fund_loans`. Columns end in the second year's last two digits."""
    fund_cols = {"uh": f"{_PF}uh_total_geral", "val": "valor_total_calculado", "pc_uh": f"{_PF}uh_pro_cotista_geral", "pc_val": f"{_PF}valor_pro_cotista_geral"}
    loan_cols = {"aq": "sbpe_aquisicao", "aq_mi": "sbpe_aquisicao_milhoes", "co": "sbpe_const", "co_mi": "sbpe_const_milhoes"}
    def sums(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
        return df.agg(*[F.sum(F.when(F.col("ano") == y, F.col(c))).cast("double").alias(f"{n}_{k}") for n, c in cols.items() for k, y in zip("ab", years, strict=True)])

    one, end = T.cross_scalars(sums(fund, fund_cols), sums(savings_loans, loan_cols)), f"{years[1] % 100:02d}"
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    uh, val = (lambda k: F.col(f"uh_{k}") + z(f"aq_{k}")), (lambda k: F.col(f"val_{k}") / 1e9 + z(f"aq_mi_{k}") / 1e3)
    change = lambda c: T.ratio_change(F.col(f"{c}_b"), F.col(f"{c}_a"), 0)
    billions = lambda c, unit=1e9: F.round(F.col(c) / unit, 2)
    return one.select(
        uh("b").alias(f"mcmv_sbpe_uh_{end}"), F.round(val("b"), 2).alias(f"mcmv_sbpe_val_bi_{end}"), T.ratio_change(uh("b"), uh("a"), 0).alias("mcmv_sbpe_var_uh"),
        T.ratio_change(val("b"), val("a"), 0).alias("mcmv_sbpe_var_val"), F.col("co_b").alias(f"sbpe_const_uh_{end}"), billions("co_mi_b", 1e3).alias(f"sbpe_const_bi_{end}"),
        change("co").alias("sbpe_const_var_uh"), change("co_mi").alias("sbpe_const_var_bi"), F.col("pc_uh_b").alias(f"pro_cotista_uh_{end}"), billions("pc_val_b").alias(f"pro_cotista_val_bi_{end}"),
        change("pc_uh").alias("pro_cotista_var_uh"), change("pc_val").alias("pro_cotista_var_val"), F.col("uh_b").alias(f"fin_pf_uh_{end}"), billions("val_b").alias(f"fin_pf_val_bi_{end}"),
        change("uh").alias("fin_pf_var_uh"), change("val").alias("fin_pf_var_val"),
    )


COMPANIES = ["MRV", "Cury", "Tenda", "Direcional", "Pacaembu", "Plano & Plano"]


def company_balances(quarters: DataFrame, value: str, at: tuple[int, int], order: Sequence[str] = COMPANIES) -> DataFrame:
    """P18. ``empresa, ano, trimestre`` and a value: quarter and 12-month comparisons in the report's order."""
    return T.order_by_rank(T.quarter_comparison(quarters, "empresa", value, "ano", "trimestre", at), "empresa", order)


#: Regions of the launches report, in report order: name to the ending of their columns.
LAUNCH_REGIONS = {"NORTE": "norte", "NORDESTE": "nordeste", "CENTRO-OESTE": "centro_oeste", "SUDESTE": "sudeste", "SUL": "sul"}


def launches_national(quarters: DataFrame, what: str, periods: Sequence[tuple[str, str, str]]) -> DataFrame:
    """P19. Launches or sales (``what``) in all, of the programme and others, by period."""
    own = quarters.select("ano", "trimestre", *[F.col(f"cbic_{what}_{c}").alias(c) for c in ("total", "mcmv", "demais")])
    return quarter_periods(own, ["total", "mcmv", "demais"], periods)


def launches_by_region(quarters: DataFrame, what: str, at: Sequence[tuple[int, int]], regions: Mapping[str, str] = LAUNCH_REGIONS) -> DataFrame:
    """P19. Launches or sales by region in the quarter ``at[0]``, with the programme's share there and in the other
    quarters of ``at`` (the one before, that of a year ago); one pass over the exploded regions."""
    groups = {r: {"total": f"cbic_{what}_regiao_{c}", "mcmv": f"cbic_{what}_mcmv_regiao_{c}", "perc": f"cbic_{what}_mcmv_perc_regiao_{c}"} for r, c in regions.items()}
    long = T.unpivot_groups(quarters, ["ano", "trimestre"], groups, "regiao")
    here = lambda q: (F.col("ano") == q[0]) & (F.col("trimestre") == q[1])
    share = lambda q: F.round(F.max(F.when(here(q), F.col("perc"))).cast("double"), 1).alias(f"perc_mcmv_{q[1]}t{q[0] % 100:02d}")
    now = [F.max(F.when(here(at[0]), F.col(c))).alias(c) for c in ("total", "mcmv")]
    rows = long.groupBy("regiao").agg(F.count_if(here(at[0])).alias("_n"), *now, *map(share, at)).where("_n > 0").drop("_n")
    return T.order_by_rank(rows, "regiao", list(regions))


def market_indices(stock: DataFrame, rent: DataFrame, confidence: DataFrame, materials: DataFrame, year: int) -> DataFrame:
    """P20. Changes of four indices over four periods that end in December of ``year`` and of the year before it.

    ``stock`` has ``close``, ``rent`` ``var_mensal`` and ``var_ano``, ``confidence`` ``icst_sem_ajuste_sazonal``, ``materials``
    ``var_mes`` and ``var_12_meses``, each under ``data_referencia``. All values are read in one pass a series.
    """
    months = {"d0": f"{year}-12-01", "n0": f"{year}-11-01", **{f"d{k}": f"{year - k}-12-01" for k in (1, 2, 3)}}
    at = lambda df, cols: df.agg(*[F.max(F.when(F.col("data_referencia") == F.lit(m).cast("date"), F.col(c))).alias(f"{n}_{k}") for c, n in cols.items() for k, m in months.items()])
    one = T.cross_scalars(
        at(stock, {"close": "stock"}), at(rent, {"var_mensal": "rent", "var_ano": "rent_year"}), at(confidence, {"icst_sem_ajuste_sazonal": "trust"}), at(materials, {"var_mes": "m", "var_12_meses": "my"})
    )
    c, pct = F.col, lambda x: F.round(x * 100, 2)
    change = lambda a, b, digits=2: T.ratio_change(c(a), c(b), digits)
    y, y1 = f"{year % 100:02d}", f"{(year - 1) % 100:02d}"
    lines = [
        (f"DEZ {y} vs. NOV {y}", change("stock_d0", "stock_n0", 1), pct(c("rent_d0")), change("trust_d0", "trust_n0"), c("m_d0")),
        (f"DEZ {y} vs. DEZ {y1}", change("stock_d0", "stock_d1", 1), pct(F.try_divide(1 + c("rent_d0"), 1 + c("rent_d1")) - 1), change("trust_d0", "trust_d2"), c("my_d0")),
        (f"JAN-DEZ/{y}", change("stock_d0", "stock_d1", 1), pct(c("rent_year_d0")), change("trust_d0", "trust_d2"), c("my_d0")),
        (f"JAN-DEZ/{y1}", change("stock_d1", "stock_d2", 1), pct(c("rent_year_d2")), change("trust_d3", "trust_d2"), c("my_d2")),
    ]
    rows = F.array(*[F.struct(F.lit(p).alias("periodo"), a.alias("imob_var"), b.alias("fipezap_var"), d.alias("icst_var"), e.alias("abramat_var")) for p, a, b, d, e in lines])
    return one.select(F.posexplode(rows).alias("ordem", "r")).orderBy("ordem").select("r.*")


#: Companies of the ticket report: name to prefix.
TICKETS = {"MRV": "mrv", "Direcional": "dir", "Tenda": "ten"}


def ticket_against_cost(tickets: DataFrame, cost: DataFrame, base_date: str, first: tuple[int, int], companies: Mapping[str, str] = TICKETS) -> DataFrame:
    """P21. Changes of the companies' tickets on the quarter and since the base (``empresa, ano, trimestre, var_tri,
    acum``) beside the cost index's, from the quarter ``first`` on; ``cost`` is the output of :func:`cost_index`."""
    of = lambda name, c: F.round(F.max(F.when(F.col("empresa") == name, F.col(c))).cast("double"), 1)
    wide = tickets.groupBy("ano", "trimestre").agg(
        *[of(n, "var_tri").alias(f"{p}_var_tri") for n, p in companies.items()], *[of(n, "acum").alias(f"{p}_acum_4t20") for n, p in companies.items()]
    )
    ends = F.month("data_referencia") % 3 == 0
    quarter = lambda c: F.max(F.when(ends, F.col(c)))
    index = cost.groupBy("ano", "trimestre").agg(F.round(quarter("var_tri"), 1).alias("incc_var_tri"), quarter("indice").alias("_index"))
    base = cost.agg(F.max(F.when(F.col("data_referencia") == F.lit(base_date).cast("date"), F.col("indice"))).alias("_base"))
    index = index.crossJoin(F.broadcast(base)).withColumn("incc_acum_4t20", T.ratio_change(F.col("_index"), F.col("_base"))).drop("_index", "_base")
    both = T.enrich(wide, [(index, ["ano", "trimestre"])], checked=False)
    order = ["incc_var_tri", *[f"{p}_var_tri" for p in companies.values()], "incc_acum_4t20", *[f"{p}_acum_4t20" for p in companies.values()]]
    return both.where(F.col("ano") * 4 + F.col("trimestre") >= first[0] * 4 + first[1]).orderBy("ano", "trimestre").select("ano", "trimestre", *order)


# --- continuous bulletin ------------------------------------------------------------------------------------


_FAIXAS = ["uh_pro_cotista_faixa_1", "uh_pro_cotista_faixa_2", "uh_pro_cotista_faixa_3", "uh_pro_cotista_classe_media"]
_BANDS = ["total_geral", "total_faixa_1", "total_faixa_2", "total_faixa_3", "faixa_3_sem_fundo_social", "faixa_3_fundo_social", "total_classe_media", "fora_mcmv_apoio_e_cci"]
_BANKS = ["caixa", "bradesco", "itau", "santander", "bb"]

#: P23. Slices of the monthly table: columns, and those of which one at least must have a value.
MONTHLY_SLICES: Mapping[str, tuple[list[str], list[str]]] = {
    "canal_fgts": (
        [f"{_PF}{m}_pro_cotista_{b}" for b in ("geral", "faixa_1", "faixa_2", "faixa_3", "classe_media") for m in ("uh", "valor")], [_PF + c for c in _FAIXAS],
    ),
    "empregos_caged": (
        [f"{p}_{m}{v}" for p in ("emprego_const", "caged_total") for m in ("saldo", "estoque") for v in ("", "_var_mes", "_var_12_meses")], ["emprego_const_saldo", "caged_total_saldo"],
    ),
    "financiamento_pf_faixa": (
        [f"{_PF}{m}_{b}" for b in _BANDS for m in ("uh", "valor")], [f"{_PF}uh_total_{b}" for b in ("faixa_1", "faixa_2", "faixa_3", "classe_media")],
    ),
    "fipezap": (
        ["indice_fipezap_numero_indice_locacao", "indice_fipezap_locacao_var_mes", "indice_fipezap_locacao_var_mes_vs_mes_ano_ant", "indice_fipezap_locacao_acum_ano"],
        ["indice_fipezap_numero_indice_locacao"],
    ),
    "funding": (["funding_sbpe", "funding_fgts", *[f"anbima_estoque_{c}" for c in ("lci", "lca", "cri", "cra", "lig")]], ["funding_sbpe", "funding_fgts"]),
    "icst": (
        ["icst_serie_original_sem_ajuste_sazonal", "indice_icst_var_mes_serie_original", "indice_icst_var_mes_vs_mes_ano_ant_serie_original", "indice_icst_var_acum_ano_serie_original"],
        ["icst_serie_original_sem_ajuste_sazonal"],
    ),
    "indice_imob": (["indice_imob_var_mes", "indice_imob_var_mes_vs_mes_ano_ant", "indice_imob_var_acum_ano"], ["indice_imob_var_mes"]),
    "novos_financiamentos_banco": (
        [f"abecip_sbpe_fin_{m}_acum_{b}" for m in ("uh", "milhoes") for b in (*_BANKS, "total")], [f"abecip_sbpe_fin_uh_acum_{b}" for b in _BANKS],
    ),
    "uh_condicao_uso": ([f"abecip_sbpe_fin_{m}_aq_{c}" for m in ("uh", "milhoes") for c in ("novos", "usados")], ["abecip_sbpe_fin_uh_aq_novos", "abecip_sbpe_fin_uh_aq_usados"]),
}

_CHANGES = ["tri_anterior", "mesmo_tri_ano_anterior", "acumulado_mesmo_periodo_ano_anterior"]
_TICKET = "ticket_medio_lancamentos_"

#: P24. Slices of quarterly tables: columns under their report names.
QUARTERLY_SLICES: Mapping[str, Mapping[str, str]] = {
    "balancos_empresas_totais": {c: c for m in ("lancamentos", "vendas") for c in (f"{m}_totais", *[f"var_{m}_totais_{v}" for v in _CHANGES])},
    "financiamentos_habitacionais": {c: c for p in ("financ_hab_fgts_pj", "financ_hab_sbpe_constr") for c in (p, f"{p}_acumulado_12_meses")},
    "pib_construcao_civil_pct": {
        "var_trim_trim_anterior": "pib_const_trimestre_anterior", "var_acumulada_ano": "pib_const_taxa_acumulada_ano", "var_acumulada_4_trimestres": "pib_const_taxa_acumulada_4_trimestres",
    },
    "ticket_medio": {
        c: c for c in ("precos_incc_tri", "incc_var_tri_ant", "incc_var_acum_4t2020", *[f"{_TICKET}{e}{v}" for e in ("mrv", "direcional", "tenda", "cury") for v in ("", "_var_tri_ant", "_var_acum_4t2020")])
    },
}


def monthly_slice(df: DataFrame, name: str) -> DataFrame:
    """P23. A slice of the wide monthly table (``periodo, ano, mes``) with the month's first day, newest first."""
    cols, require = MONTHLY_SLICES[name]
    rows = T.require_any(df.select("periodo", "ano", "mes", *cols), require)
    return rows.select("periodo", "ano", "mes", C.month_start("ano", "mes").alias("data_referencia"), *cols).orderBy(F.desc("ano"), F.desc("mes"))


def quarterly_slice(df: DataFrame, name: str) -> DataFrame:
    """P24. A slice of a quarterly table (``periodo, ano`` and a ``trimestre`` that starts with the quarter's number),
    newest first; rows without any value stay."""
    day = C.quarter_start("ano", F.col("trimestre").cast("string")).alias("data_referencia")
    return df.select("periodo", "ano", "trimestre", day, *[F.col(c).alias(n) for n, c in QUARTERLY_SLICES[name].items()]).orderBy(F.desc("ano"), F.desc("trimestre"))


#: P25. Series that are shown as they come: report name to column, and the column that dates them.
DIRECT_SERIES: Mapping[str, tuple[str, Mapping[str, str]]] = {
    "credito_pib": ("data", {"data": "data", "credito_imobiliario_pib_pct": "valor"}),
    "fgts_valor_medio": ("mes", {c: c for c in ("ano", "mes", *[f"{v}{f}{p}" for f in ("", "_f1") for v, p in (("valor_medio_fgts", ""), ("var_fgts", "_mes"), ("var_fgts", "_12m"), ("var_fgts", "_acum_ano"))])}),
    "incc_m": ("mes", {c: c for c in ("mes", "indice", "var_mes", "var_ano", "var_12_meses")}),
    "saldo_poupanca": ("data_referencia", {c: c for c in ("data_referencia", "deposito", "retirada", "captacao_liquida_valor", "captacao_liquida_pct", "saldo")}),
}


def direct_series(df: DataFrame, name: str) -> DataFrame:
    """P25. A series under report names, newest first. Months as ``MM/yyyy`` are ordered by the date they stand for, which
    the report of average values also shows as ``data_referencia``."""
    at, values = DIRECT_SERIES[name]
    order = C.period_to_date(at, "mm/yyyy") if at == "mes" else F.col(at)
    shown = [order.alias("data_referencia")] if name == "fgts_valor_medio" else []
    return df.orderBy(order.desc_nulls_last()).select(*[F.col(c).alias(n) for n, c in values.items()], *shown)


#: P26. Long series that become a column per code: code column and columns by code.
PIVOTS: Mapping[str, tuple[str, Mapping[str, str]]] = {
    "financiamentos_imobiliarios_pf_pj": ("tipo", {f"{p}_{c}": f"{n}_{p}_{u}" for c, n, u in (("concessoes_rs_mi", "concessoes", "rs_mi"), ("taxa_juros_aa", "taxa_juros", "aa"), ("inadimplencia_pct", "inadimplencia", "pct")) for p in ("pf", "pj")}),
    "pib_construcao_civil": ("variavel_id", {"6564": "var_trim_trim_anterior", "6561": "var_trim_mesmo_trim_ano_anterior", "6563": "var_acumulada_ano", "6562": "var_acumulada_4_trimestres"}),
    "pnad_ocupados": ("categoria_id", {"47949": "ocupados_construcao_mil", "47946": "ocupados_total_mil"}),
    "pnad_rendimento": ("categoria_id", {"47949": "rendimento_construcao_rs", "47946": "rendimento_total_rs"}),
    "sinapi": ("variavel_id", {"48": "custo_medio_m2", "1196": "var_mes", "1197": "var_acum_ano", "1198": "var_12_meses"}),
}


def pivoted_series(df: DataFrame, name: str, keys: Sequence[str] = ("periodo",)) -> DataFrame:
    """P26. A long series (``keys``, a code, ``valor``) to a column per code, newest first."""
    code, mapping = PIVOTS[name]
    return T.pivot_codes(df, list(keys), code, "valor", mapping).orderBy(F.desc(keys[0]))


#: P27. Variables of industrial output and of retail volume.
OUTPUT = {"11601": "pim_pf_var_mes", "11603": "pim_pf_var_acum_ano", "11604": "pim_pf_var_12_meses"}
RETAIL = {"11708": "pmc_var_mes", "11710": "pmc_var_acum_ano", "11711": "pmc_var_12_meses"}


def output_and_retail(output: DataFrame, retail: DataFrame, category: str = "56734") -> DataFrame:
    """P27. Industrial output and, of one category, retail volume over all months of either, newest first."""
    pim = T.pivot_codes(output, "periodo", "variavel_id", "valor", OUTPUT)
    pmc = T.pivot_codes(retail.where(F.col("categoria_id") == category), "periodo", "variavel_id", "valor", RETAIL)
    both = T.full_outer_coalesce(pim, pmc, "periodo").withColumn("data_referencia", C.period_to_date("periodo"))
    return both.orderBy(F.desc("periodo")).select("periodo", "data_referencia", *OUTPUT.values(), *RETAIL.values())


#: P28. Companies of the quarterly table: name to the beginning of their columns.
COMPANY_PREFIXES = {"MRV": "mrv", "Cury": "cury", "Tenda": "tenda", "Direcional": "direcional", "Pacaembu": "pacaembu", "Plano & Plano": "plano_plano"}


def company_rows(wide: DataFrame, companies: Mapping[str, str] = COMPANY_PREFIXES) -> DataFrame:
    """P28. One wide row a quarter (``periodo, ano, trimestre``) to a row per company that has launches or sales."""
    def columns(prefix: str) -> dict[str, str]:
        found = {}
        for m, one in (("lancamentos", "lancamento"), ("vendas", "vendas")):
            found[m] = f"{prefix}_{m}"
            found |= {f"var_{m}_{v}": f"{prefix}_var_{m}_{v}" for v in _CHANGES[:2]}
            found[f"var_{m}_acumulado_periodo_ano_anterior"] = f"{prefix}_var_{one}_{_CHANGES[2]}"
        return found

    long = T.unpivot_groups(wide, ["periodo", "ano", "trimestre"], {n: columns(x) for n, x in companies.items()}, "empresa")
    rows = T.require_any(long, ["lancamentos", "vendas"]).withColumn("data_referencia", C.quarter_start("ano", F.col("trimestre").cast("string")))
    return rows.orderBy(F.desc("ano"), F.desc("trimestre"), "empresa")


#: P22. Staged series that the continuous bulletin reads: model to path under the staging area. Fixed values.
STAGED_READS = {
    "abecip_poupanca_sbpe": "abecip/poupanca_sbpe_mensal", "bacen_credito_pib": "bacen/credito_imobiliario_pib", "bacen_financiamentos_imobiliarios": "bacen/financiamentos_imobiliarios",
    "fgv_icst": "fgv/icst", "fgv_incc_m": "fgv/incc_m", "fipezap_locacao": "fipe/indice_locacao", "ibge_paic_obras": "ibge/paic_obras",
    "ibge_paic_pessoal_salarial": "ibge/paic_pessoal_salarial", "ibge_paic_resultados": "ibge/paic_resultados", "ibge_pib_consolidado_trimestral": "ibge/pib_consolidado_trimestral_bruto",
    "ibge_pib_construcao_civil": "ibge/pib_construcao", "ibge_pib_corrente": "ibge/pib_corrente_milhoes_brl", "ibge_pim_pf_brasil": "ibge/ibge_pim_pf_brasil", "ibge_pmc_construcao": "ibge/ibge_pmc_construcao",
    "ibge_pnad_construcao_ocupados": "ibge/pnad_construcao_ocupados", "ibge_pnad_construcao_rendimento": "ibge/pnad_construcao_rendimento",
    "ibge_pnadc_populacao_decis_renda": "ibge/pnadc_populacao_decis_renda", "ibge_pnadc_rendimento_domiciliar": "ibge/pnadc_rendimento_domiciliar_real", "ibge_sinapi": "ibge/sinapi",
    "infomoney_imob": "infomoney/acoes_imob", "novo_caged": "novo_caged/saldo_estoque_construcao_edificios", "siafi_dotacao_execucao": "siafi/dotacao_execucao",
}
#: P22. Tables that it reads where they are (:func:`marajo.sources.files.read_table`): model to table.
TABLE_READS = {
    "empresas_balanco_lancamentos_vendas": "empresas_balanco_lancamentos_vendas", "fgts_valor_medio_imoveis": "fgts_valor_medio_imoveis", "manual_mensais": "dados_mensais",
    "manual_trimestrais": "dados_trimestrais", "pib_construcao_civil_pct": "ibge_pib_construcao_civil", "sbpe_financiamentos_aquisicao": "sbpe_financiamentos_aquisicao_bancos",
}


def staged_series(spark: SparkSession, staging: str, model: str, columns: Sequence[str] = ("*",)) -> DataFrame:
    """P22. A staged series of the continuous bulletin; ``staging`` is the folder that holds all of them."""
    return spark.read.parquet(f"{staging.rstrip('/')}/{STAGED_READS[model]}.parquet").select(*columns)


#: Budget actions of the report: code to name, in report order. Fixed values.
BUDGET_ACTIONS = {"00AF": "FAR", "00CY": "FDS", "00CX": "PNHR", "00TI": "FNHIS", "00CW": "PNHU", "0E64": "OFERTA P.", "00XF": "FUNDO SOC."}
BUDGET_AMOUNTS = {"dotacao_atualizada": "dotacao_atualizada", "despesas_empenhadas": "empenho", "despesas_pagas": "pagamento", "restos_a_pagar_inscritos": "rap_inscrito", "restos_a_pagar_pagos": "pag_rap"}


def federal_budget(raw: DataFrame, actions: Mapping[str, str] = BUDGET_ACTIONS) -> DataFrame:
    """P29. Budget lines in Brazilian text by listed action, with all payments and the row ``SOMA``."""
    code = F.col("acao_governo_codigo")
    rows = raw.where(code.isin(*actions)).select(code, *[C.num_br(c, "decimal(38,2)").alias(n) for c, n in BUDGET_AMOUNTS.items()])
    sums = T.with_total(rows, [], "acao_governo_codigo", list(BUDGET_AMOUNTS.values()), "SOMA")
    order = T.rank_of("acao_governo_codigo", [*actions, "SOMA"])
    named = sums.select(
        "acao_governo_codigo", C.decode("acao_governo_codigo", dict(actions) | {"SOMA": "SOMA"}, None).alias("acao_nome"), *BUDGET_AMOUNTS.values(),
        C.sum_components("pagamento", "pag_rap").alias("pag_total"), order.alias("ordem"),
    )
    return named.orderBy("ordem")

"""Programme pipelines over raw text tables that are derived from the order star, with all columns of each model.

The raw tables write clean columns the way the lender does (Brazilian money and dates, dashed keys, blanks); the SQL
takes the clean columns. Amounts are whole numbers, so sums don't depend on their order. Days that are made of a key take it
modulo a million, as a year has four digits; the other columns settle which of two rows of a day is the latest.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marajo.plans import programme_tables as R
from marajo.plans import programmes as P
from marajo.plans.kit import Kit, rounded
from marajo.session import spread, stash, unfused

kit = Kit()
QUERIES, ORACLES = kit.queries, kit.oracles


def _br(c):
    return F.translate(F.format_number(c, 2), ",.", ".,")


def _day(c):
    return F.date_format(c, "dd/MM/yyyy")


def _text(c):
    return c.cast("string")


# --- bronze: every column of the eleven raw tables ----------------------------------------------------------


def _raw_value(kind: str, j: int):
    """Text of the ``j``-th column as the source may write it, from an order."""
    k, d = F.col("o_orderkey"), F.date_add(F.col("o_orderdate").cast("date"), j)
    seven, code = (k + j) % 7, (k * j) % 1000
    word, amount = F.concat(F.lit(" T"), _text((k * j) % 97), F.lit(" ")), F.col("o_totalprice").cast("decimal(12,2)") + j
    root = F.lpad(_text(k % 1_000_000), 6, "0")
    return {
        "key": lambda: F.when(k % 3 == 0, F.concat(F.lit("00"), root, F.lit("-03"))).otherwise(F.concat(root, F.lit("03"))),
        "text": lambda: F.when(seven == 0, "  ").otherwise(word),
        "trimmed": lambda: word,
        "text_none": lambda: F.when(seven == 0, "None").when(seven == 1, "").otherwise(word),
        "tax_id": lambda: F.when(seven == 0, "--").otherwise(F.concat(F.lit("12."), F.lpad(_text(code), 3, "0"), F.lit("/0001-9"))),
        "int": lambda: F.when(seven == 0, "None").when(seven == 1, "x").otherwise(F.concat(F.lit(" "), _text(code), F.lit(" "))),
        "number": lambda: F.when(seven == 0, "").otherwise(F.concat(_text(code), F.lit(",25"))),
        "percent": lambda: F.when(seven == 0, "None").otherwise(F.concat(_text(code), F.lit(",5"))),
        "degrees": lambda: F.when(seven == 0, "").otherwise(F.concat(F.lit("-"), _text(code % 90), F.lit(".12345678"))),
        "money": lambda: F.when(seven == 0, "NaN").when(seven < 4, _br(amount)).otherwise(_text(amount)),
        "date": lambda: F.when((k + j) % 4 == 0, _day(d)).when((k + j) % 4 == 1, F.date_format(d, "yyyyMMdd")).when((k + j) % 4 == 2, F.date_format(d, "yyyy-MM-dd HH:mm:ss")).otherwise("n/a"),
        "flag": lambda: F.when((k + j) % 3 == 0, "S").when((k + j) % 3 == 1, " S ").when((k + j) % 6 == 2, "N"),
        "audit": lambda: F.concat(F.lit("a"), _text(k + j)),
    }[kind]()


def _clean_value(kind: str, j: int) -> str:
    """DuckDB's expression of the same column, typed."""
    k, seven, code = "o_orderkey", f"(o_orderkey + {j}) % 7", f"(o_orderkey * {j}) % 1000"
    word = f"'T' || (o_orderkey * {j}) % 97"
    return {
        "key": f"lpad(cast({k} % 1000000 as varchar), 6, '0') || '03'",
        "text": f"case when {seven} <> 0 then {word} end",
        "trimmed": word,
        "text_none": f"case when {seven} > 1 then {word} end",
        "tax_id": f"case when {seven} <> 0 then '12' || lpad(cast({code} as varchar), 3, '0') || '00019' end",
        "int": f"case when {seven} > 1 then cast({code} as int) end",
        "number": f"case when {seven} <> 0 then cast({code} + 0.25 as double) end",
        "percent": f"case when {seven} <> 0 then cast({code} + 0.5 as double) end",
        "degrees": f"case when {seven} <> 0 then cast(-(({code}) % 90 + 0.12345678) as double) end",
        "money": f"case when {seven} = 0 then 0.0 else cast(cast(o_totalprice as decimal(12, 2)) + {j} as double) end",
        "date": f"case when ({k} + {j}) % 4 <> 3 then strftime(cast(o_orderdate as date) + {j}, '%Y-%m-%d') end",
        "flag": f"({k} + {j}) % 3 <> 2",
        "audit": f"'a' || ({k} + {j})",
    }[kind]


def raw_table(t, table):
    """A raw text table; of several names of a column all but the last are blank in every other row."""
    raw = []
    for j, (sources, _, kind) in enumerate(table, 1):
        value = _raw_value(kind, j)
        raw += [(value if i == len(sources) - 1 else F.when(F.col("o_orderkey") % 2 == 0, value).otherwise("")).alias(s) for i, s in enumerate(sources)]
    return _few_columns(t).select(*raw)


def _few_columns(t):
    """What the raw tables are made of: narrow rows, of each of which dozens of columns are made."""
    return spread(t("orders").select("o_orderkey", "o_totalprice", "o_orderdate"))


def _bronze_query(name: str, table, only: str | None = None) -> None:
    """Register the typing of one raw table; ``only`` is the programme that the lender's snapshot is cut down to."""
    names = [n for _, n, _ in table]
    fixed = {"modalidade": f"'{only}'"} if only else {}
    columns = ", ".join(f"{fixed.get(n) or _clean_value(kind, j)} as {n}" for j, (_, n, kind) in enumerate(table, 1))

    @kit.query(name, f"select {columns} from orders" + (" where o_orderkey % 2 = 0" if only else ""))
    def _(t):
        raw = []
        for j, (sources, n, kind) in enumerate(table, 1):
            value = _raw_value(kind, j)
            if n in fixed:
                value = F.when(F.col("o_orderkey") % 2 == 0, f" {only} ").otherwise("OUTRA")
            for i, source in enumerate(sources):  # all but the last of several names are blank in every other row
                raw.append((value if i == len(sources) - 1 else F.when(F.col("o_orderkey") % 2 == 0, value).otherwise("")).alias(source))
        found = P.bronze(_few_columns(t).select(*raw), table)
        if only:
            found = P.priority_of(found, only)
        with unfused(t.spark):
            found = stash(found, "bronze")
        kinds = {n: kind for _, n, kind in table}
        plain = {"date": "string", "money": "double", "percent": "double", "degrees": "double"}
        return found.select(*[F.col(n).cast(plain[kinds[n]]).alias(n) if kinds[n] in plain else F.col(n) for n in names])


for _name, _columns in R.A.items():
    _bronze_query(f"p30_bronze_{_name}", _columns, "FAR" if _name == "priority" else None)
for _name, _columns in R.B.items():
    _bronze_query(f"p38_bronze_{_name}", _columns)


# --- programme A --------------------------------------------------------------------------------------------

AS_OF = "2022-01-01"

_CLEAN = f"""
reg as (select lpad(cast(c_custkey as varchar), 6, '0') || '03' as apf, c_custkey as k, c_name as nome, n_name as uf0, 'M' || (c_custkey % 40) as cidade, cast(c_custkey % 500 as int) as uh,
  cast(round(abs(c_acctbal)) as double) as invest, cast(c_custkey % 5 as int) as tipo, case when c_custkey % 3 <> 0 then cast(c_custkey % 101 as double) end as obra, c_mktsegment as agente,
  date '2010-01-01' + cast(c_custkey % 3000 as int) as contratacao, case c_mktsegment when 'BUILDING' then 'EM ANDAMENTO' when 'MACHINERY' then 'ENTREGUE' when 'HOUSEHOLD' then 'PARALISADO' end as situacao,
  case when c_custkey % 4 <> 0 then date '2021-06-01' + cast(c_custkey % 500 as int) end as previsao, case when c_custkey % 7 = 0 then date '2020-05-17' end as entrega, cast(c_custkey % 1000 as double) as aporte,
  cast(c_custkey % 9000 as double) as gasto from customer join nation on c_nationkey = n_nationkey),
prop as (select * from (select o_custkey as k, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as mov, o_orderkey as ok from orders)
  qualify row_number() over (partition by k order by mov desc nulls first, date '2000-01-01' + cast(ok % 1000000 as int) desc, case when ok % 4 > 0 then cast(ok % 7 as varchar) end desc nulls first,
    lpad(cast(ok % 100 as varchar), 2, '0') desc, 'prop ' || ok % 13 desc, case when ok % 5 <> 0 then ok % 10 end desc nulls first, 'tom ' || ok % 11 desc, case when ok % 9 <> 0 then ok % 4 end desc nulls first, ok % 9 desc) = 1),
pay as (select o_custkey as k, cast(date_trunc('month', o_orderdate) as date) as mes, count(*) as n, sum(cast(round(o_totalprice) as bigint)) as v, sum(o_orderkey) as obra, sum(o_orderkey % 7) as terreno from orders group by 1, 2),
ent as (select apf, reg.k, case when ok % 4 > 0 then cast(ok % 7 as varchar) else 'Não informada' end as portaria_selecao, '77' || lpad(cast(ok % 100 as varchar), 2, '0') as proponente_cnpj, 'prop ' || ok % 13 as proponente_nome,
  case when ok % 5 <> 0 then '88' || ok % 10 end as tomador_cnpj, 'tom ' || ok % 11 as tomador_nome, nome as empreendimento_nome, uh as quantidade_uh, case when prop.k is not null then cidade end as municipio,
  case when prop.k is not null then uf0 end as uf, case when ok % 9 <> 0 then cast(ok % 4 as int) end as co_originacao, cast(ok % 9 as int) as co_tipo_demanda,
  coalesce(situacao, 'Situação não mapeada') as situacao_empreendimento, tipo as codigo_tipologia,
  case tipo when 1 then 'Casa Térrea' when 2 then 'Apartamento' when 3 then 'Sobrado' when 4 then 'Misto' else 'Não Informado' end as tipologia, cast(floor(uh * 3.3) as bigint) as pessoas_atendidas,
  invest as valor_contratado, agente as agente_financeiro, strftime(contratacao, '%Y-%m-%d') as dt_contratacao, aporte as valor_aporte_adicional, case when uh > 0 then invest / uh else 0.0 end as valor_por_uh,
  coalesce(obra, 50.0) as percentual_execucao_fisica, case when reg.k % 5 = 0 then '2021-02-03' end as dt_conclusao_obra, strftime(entrega, '%Y-%m-%d') as dt_entrega, strftime(previsao, '%Y-%m-%d') as dt_previsao_entrega,
  gasto as valor_desembolsado, case when invest > 0 then gasto / invest * 100 else 0.0 end as percentual_execucao_financeira from reg left join prop on prop.k = reg.k),
sheet as (select apf, portaria_selecao, upper(empreendimento_nome) as nome_empreendimento, proponente_cnpj, upper(proponente_nome) as nome_proponente, tomador_cnpj, upper(tomador_nome) as nome_tomador, agente_financeiro,
  quantidade_uh, pessoas_atendidas, tipologia, municipio, uf, coalesce(municipio, '') || '/' || coalesce(uf, '') as municipio_uf,
  apf || ' - ' || coalesce(municipio, '') || '/' || coalesce(uf, '') || ' - ' || upper(empreendimento_nome) as apf_municipio_empreendimento,
  case co_originacao when 1 then 'SELEÇÃO' when 2 then 'CALAMIDADE/EMERGÊNCIA' else 'OUTRO (' || coalesce(cast(co_originacao as varchar), 'N/A') || ')' end as metodo,
  case co_tipo_demanda when 1 then 'CADASTRO HABITACIONAL' when 2 then 'MOVIMENTOS SOCIAIS' when 3 then 'CALAMIDADE' when 4 then 'OBRA PÚBLICA' when 5 then 'REASSENTAMENTO' when 6 then 'DOAÇÃO/CESSÃO DE TERRENO'
    when 7 then 'OUTROS' else 'NÃO IDENTIFICADO (' || coalesce(cast(co_tipo_demanda as varchar), 'N/A') || ')' end as demanda, situacao_empreendimento,
  case when percentual_execucao_fisica = 100 then 'Concluído' when percentual_execucao_fisica = 0 then 'Não Iniciado' else 'Em Andamento' end as status_execucao_simplificado,
  valor_contratado, valor_aporte_adicional, valor_por_uh, dt_contratacao, percentual_execucao_fisica, dt_previsao_entrega, dt_conclusao_obra, dt_entrega,
  case when situacao_empreendimento <> 'ENTREGUE' and dt_previsao_entrega < '{AS_OF}' then 'Em Atraso' when situacao_empreendimento = 'ENTREGUE' then 'Entregue' else 'Dentro do Prazo' end as status_prazo,
  valor_desembolsado, percentual_execucao_financeira,
  case when percentual_execucao_financeira > percentual_execucao_fisica + 5 then 'Desembolso Adiantado' when percentual_execucao_financeira < percentual_execucao_fisica - 5 then 'Desembolso Atrasado'
    else 'Ritmo Equilibrado' end as ritmo_fisico_financeiro from ent),
curve as (select apf, mes, n as qt_liberacoes, cast(v as double) as vr_liberado_mes, cast(pay.obra as double) as vr_pago_obra_mes, cast(terreno as double) as vr_pago_terreno_mes, 0.0 as vr_pago_pts_mes, 0.0 as vr_pago_incc_mes,
  0.0 as vr_pago_aporte_mes, 0.0 as vr_pago_equipamentos_mes, 0.0 as vr_pago_manutencao_mes, 0.0 as vr_pago_legalizacao_mes, cast(sum(v) over w as double) as vr_acumulado,
  case when valor_contratado > 0 then round(sum(v) over w / valor_contratado * 100, 2) else 0.0 end as pct_executado_financeiro, valor_contratado, municipio, uf
  from pay join ent using (k) window w as (partition by apf order by mes))"""


def _raw_a(t):
    """Programme A's raw text tables by name."""
    k = F.col("c_custkey")
    key = F.lpad(_text(k), 6, "0")
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    dashed = F.when(k % 2 == 0, F.concat(F.lit("00"), key, F.lit("-03"))).otherwise(F.concat(key, F.lit("03")))
    late = lambda first, n: _day(F.date_add(F.lit(first).cast("date"), (k % n).cast("int")))
    register = c.select(
        dashed.alias("nu_apf"), F.concat(F.lit(" P"), _text(k), F.lit(" ")).alias("no_identificacao_proposta"), F.col("c_name").alias("no_empreendimento"),
        _text(k % 500).alias("nu_qt_uh"), _br(F.round(F.abs("c_acctbal"))).alias("vr_total_investimento"), _text(k % 5).alias("co_tipo_edificacao"),
        F.col("c_mktsegment").alias("no_agente_financeiro"), late("2010-01-01", 3000).alias("dt_contratacao"),
    )
    place = c.select(k.alias("o_custkey"), F.col("n_name").alias("no_uf"), F.concat(F.lit("M"), _text(k % 40)).alias("no_municipio"))
    ok = F.col("o_orderkey")
    proposals = t("orders").join(place, "o_custkey").select(
        F.concat(F.lit("P"), _text(F.col("o_custkey"))).alias("no_identificacao_proposta"), F.when(F.col("o_orderstatus") != "P", _day("o_orderdate")).alias("dt_movimento"),
        F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), (ok % 1_000_000).cast("int")), "yyyy-MM-dd").alias("dt_protocolo"),
        F.when(ok % 4 > 0, _text(ok % 7)).alias("nu_portaria_contratacao"), "no_municipio", "no_uf", F.when(ok % 9 != 0, _text(ok % 4)).alias("co_originacao_empreendimento"),
        _text(ok % 9).alias("co_tipo_de_demanda"), F.concat(F.lit("77/"), F.lpad(_text(ok % 100), 2, "0")).alias("nu_cnpj_proponente"), F.concat(F.lit(" prop "), _text(ok % 13)).alias("no_proponente"),
        F.when(ok % 5 != 0, F.concat(F.lit("88-"), _text(ok % 10))).otherwise(" / ").alias("nu_cnpj_tomador"), F.concat(F.lit("tom "), _text(ok % 11)).alias("no_tomador"),
    )
    works = c.select(
        F.concat(key, F.lit("03")).alias("nu_apf"), F.when(k % 3 != 0, F.concat(_text(k % 101), F.lit(",0"))).alias("pc_obra_realizada"), F.lit("2020-05-17").alias("dt_alteracao_situacao"),
        F.when(k % 7 == 0, "20200517").alias("dt_entrega_do_empreendimento"), F.when(k % 5 == 0, "03/02/2021").alias("dt_conclusao_obra"),
    )
    situation = F.when(F.col("c_mktsegment") == "BUILDING", "EM ANDAMENTO").when(F.col("c_mktsegment") == "MACHINERY", "ENTREGUE").when(F.col("c_mktsegment") == "HOUSEHOLD", "PARALISADO")
    priority = c.select(
        F.concat(key, F.lit("03")).alias("apf"), F.lit(" FAR ").alias("modalidade"), situation.alias("situacao_do_empreendimento"), F.lit("50").alias("percentual_exec"),
        F.when(k % 4 != 0, late("2021-06-01", 500)).alias("data_da_previsao_da_entrega"), _br((k % 1000).cast("double")).alias("valor_aporte_adicional"), _br((k % 9000).cast("double")).alias("valor_desembolsado"),
    )
    priority = priority.unionByName(priority.withColumn("modalidade", F.lit("FDS")))  # the snapshot has other programmes too
    paid = t("orders").select(
        F.lpad(_text(F.col("o_custkey")), 6, "0").alias("nu_apf"), F.lit("0").alias("ic_credito"), _br(F.round("o_totalprice")).alias("vr_liberado"), _text(ok).alias("vr_pago_obra_empreendimento"),
        _text(ok % 7).alias("vr_pago_terreno"), _day("o_orderdate").alias("dt_liberacao_recurso"),
    )
    return {"register": register, "proposals": proposals, "works": works, "priority": priority, "disbursements": paid}


def _entity(t):
    typed = {name: P.bronze(frame, R.A[name], P.READ_A[name]) for name, frame in _raw_a(t).items()}
    return typed, P.entity_a(typed["register"], typed["proposals"], typed["works"], P.priority_of(typed["priority"]))


def _told(df, dates="dt_contratacao dt_conclusao_obra dt_entrega dt_previsao_entrega"):
    """``df`` with its dates as ISO text."""
    return df.withColumns({d: F.col(d).cast("string") for d in dates.split()})


@kit.query("p31_entity_a", f"with {_CLEAN} select * exclude (k) from ent")
def _(t):
    return _told(_entity(t)[1])


@kit.query("p32_cash_curve", f"with {_CLEAN} select * from curve", dates="mes")
def _(t):
    typed, entity = _entity(t)
    return P.cash_curve(typed["disbursements"], entity)


@kit.query("p32_cash_chart", f"""
with {_CLEAN} select apf, nome_empreendimento, apf_municipio_empreendimento, c.municipio, c.uf, upper(c.uf) as estado, mes, strftime(mes, '%Y-%m') as mes_label, strftime(mes, '%m/%Y') as mes_label_br, qt_liberacoes,
  vr_liberado_mes, vr_pago_obra_mes, vr_pago_terreno_mes, vr_pago_pts_mes, vr_pago_incc_mes, vr_acumulado, c.valor_contratado, pct_executado_financeiro from curve c join sheet using (apf)""", dates="mes")
def _(t):
    typed, entity = _entity(t)
    entity = stash(entity, "entity")
    return P.cash_chart_a(P.cash_curve(typed["disbursements"], entity), P.fact_sheet_a(entity, AS_OF), _states(t))


@kit.query("p33_physical_financial", f"""
with {_CLEAN}, w as (select apf, date '2020-05-01' as mes, obra as pct from reg),
u as (select coalesce(c.apf, w.apf) as apf, coalesce(c.mes, w.mes) as mes, w.pct, c.pct_executado_financeiro as fin from curve c full join w on c.apf = w.apf and c.mes = w.mes)
select u.apf, apf_municipio_empreendimento, strftime(mes, '%Y-%m-%d') as mes, coalesce(last_value(pct ignore nulls) over w, 0) as pct_obra_realizada, coalesce(last_value(fin ignore nulls) over w, 0) as pct_executado_financeiro
from u join sheet using (apf) window w as (partition by u.apf order by mes rows between unbounded preceding and current row)""")
def _(t):
    typed, entity = _entity(t)
    entity = stash(entity, "entity")
    return P.physical_against_financial(P.cash_curve(typed["disbursements"], entity), typed["works"], entity)


def _sheets(t):
    """Programme A's fact sheets, written once: a report reads them several times."""
    return stash(P.fact_sheet_a(_entity(t)[1], AS_OF), "sheets")


@kit.query("p34_fact_sheet", f"with {_CLEAN} select * from sheet")
def _(t):
    return _told(P.fact_sheet_a(_entity(t)[1], AS_OF))


def _states(t):
    r = t("region").withColumnRenamed("r_regionkey", "n_regionkey")
    return t("nation").join(r, "n_regionkey").select(F.col("n_name").alias("sigla"), F.col("n_name").alias("nome"), F.left("r_name", F.lit(2)).alias("regiao_sigla"), F.col("r_name").alias("regiao_nome"))


@kit.query("p35_national_map", f"""
with {_CLEAN}, u as (select uf, n_name as estado_nome, left(r_name, 2) as regiao_sigla, r_name as regiao_nome, count(distinct municipio_uf) as m, count(apf) as n, cast(sum(quantidade_uh) as bigint) as uh,
    sum(valor_contratado) as vc, sum(valor_desembolsado) as vd, avg(percentual_execucao_fisica) as pct from sheet left join nation on n_name = uf left join region on r_regionkey = n_regionkey group by all)
select uf, estado_nome, 'BR-' || uf as iso_3166_2, regiao_sigla, regiao_nome, 'uf' as nivel, m as total_municipios, n as total_empreendimentos, uh as total_uhs, vc as total_valor_contratado, vd as total_valor_desembolsado,
  round(pct, 1) as media_execucao_fisica from u
union all select regiao_sigla, regiao_nome, null, regiao_sigla, regiao_nome, 'regiao', cast(sum(m) as bigint), cast(sum(n) as bigint), cast(sum(uh) as bigint), sum(vc), sum(vd), round(avg(pct), 1) from u group by 1, 2, 4, 5""")
def _(t):
    return P.national_map(_sheets(t), _states(t))


@kit.query("p36_state_panel", f"""
with {_CLEAN}, names(dimensao, ordem) as (values ('CONCLUÍDO E ENTREGUE', 1), ('CONCLUÍDO', 2), ('EM ANDAMENTO', 3), ('PARALISADO', 4), ('NÃO INICIADO', 5), ('DESMOBILIZADO', 6)),
parts as (
  select uf, 'metodo' as secao, metodo as dimensao, 0 as ordem, count(*) as n, sum(quantidade_uh) as u from sheet group by all
  union all select uf, 'portaria', case when portaria_selecao = 'Não informada' then portaria_selecao else 'Portaria nº ' || portaria_selecao end, 0, count(*), sum(quantidade_uh) from sheet group by all
  union all select uf, 'demanda', demanda, 0, count(*), sum(quantidade_uh) from sheet group by all
  union all select g.uf, 'situacao', s.dimensao, s.ordem, coalesce(n, 0), coalesce(u, 0) from (select distinct uf from sheet) g cross join names s
    left join (select uf, situacao_empreendimento, count(*) as n, sum(quantidade_uh) as u from sheet group by all) r on r.uf is not distinct from g.uf and r.situacao_empreendimento = s.dimensao
  union all select uf, 'execucao_fisica', case when percentual_execucao_fisica <= 40 then 'Menor que 40%' when percentual_execucao_fisica <= 55 then 'De 41% a 55%' when percentual_execucao_fisica <= 75 then 'De 56% a 75%'
      else 'Maior que 75%' end, case when percentual_execucao_fisica <= 40 then 1 when percentual_execucao_fisica <= 55 then 2 when percentual_execucao_fisica <= 75 then 3 else 4 end, count(*), sum(quantidade_uh) from sheet group by all)
select uf, uf as estado, 'header' as secao, 'resumo' as dimensao, 0 as ordem, count(distinct municipio) as qtd_empreendimentos, cast(sum(quantidade_uh) as bigint) as qtd_uhs, sum(valor_contratado) as valor_1,
  sum(valor_desembolsado) as valor_2, sum(valor_aporte_adicional) as valor_3, case when sum(quantidade_uh) > 0 then sum(valor_contratado) / sum(quantidade_uh) else 0.0 end as valor_4, count(*) as total_empreendimentos_uf from sheet group by uf
union all select uf, uf, secao, dimensao, ordem, n, cast(u as bigint), cast(null as double), cast(null as double), cast(null as double), cast(null as double), cast(null as bigint) from parts""")
def _(t):
    return P.state_panel(_sheets(t), _states(t))


@kit.query("p37_management_summary", f"""
with {_CLEAN} select situacao_empreendimento, tipologia, status_execucao_simplificado, status_prazo, count(apf) as total_empreendimentos, cast(sum(quantidade_uh) as bigint) as total_uhs,
  cast(sum(pessoas_atendidas) as bigint) as total_pessoas_atendidas, sum(valor_contratado) as somatorio_valor_contratado, sum(valor_desembolsado) as somatorio_valor_desembolsado,
  avg(percentual_execucao_fisica) as media_execucao_fisica, round(avg(valor_por_uh), 6) as media_valor_por_uh from sheet group by 1, 2, 3, 4""")
def _(t):
    return P.management_summary(P.fact_sheet_a(_entity(t)[1], AS_OF)).withColumn("media_valor_por_uh", F.round("media_valor_por_uh", 6))


# --- programme B --------------------------------------------------------------------------------------------

_CLEAN_B = f"""
b as (select lpad(cast(c_custkey as varchar), 6, '0') || '03' as apf, c_custkey as k, c_name as nome, n_name as eo, lpad(cast(c_nationkey + 1 as varchar), 14, '0') as cnpj, 'M' || (c_custkey % 40) as cidade,
  ['SP', 'PA', 'BA', 'GO', 'RS', 'ZZ'][c_custkey % 6 + 1] as estado, cast(c_custkey % 90 as int) as uc, cast(c_custkey % 70 as int) as up, cast(c_custkey % 60 as int) as ali, cast(round(abs(c_acctbal) * 100) as double) as invest,
  cast(c_custkey % 101 as double) as pct, cast(c_custkey % 83 as double) as prev, cast(c_custkey % 4 as int) as tipo, cast(c_custkey % 3 as int) as reg, case when c_custkey % 6 <> 0 then cast(c_custkey % 6 as int) end as moda,
  case when c_custkey % 11 = 0 then '2021-01-01' end as parada, c_custkey % 10 as grau from customer join nation on c_nationkey = n_nationkey),
paid as (select o_custkey as k, sum(cast(round(o_totalprice) as bigint)) as v, count(*) as n, max(cast(o_orderdate as date)) as ult from orders where o_orderkey % 3 > 0 group by 1),
snap as (select o_custkey as k, case when o_orderkey % 5 = 0 then 'NORMAL' when o_orderkey % 4 = 0 then 'PARALISADA' when o_orderkey % 4 = 1 then 'NAO_INICIADA_CLAUSULA_SUSPENSIVA' when o_orderkey % 4 = 2 then 'NORMAL' end as gefus,
    'fase ' || case when o_orderkey % 5 = 0 then 0 else o_orderkey % 3 end as fase from orders where o_orderstatus <> 'P'
  qualify row_number() over (partition by o_custkey order by case when o_orderkey % 5 > 0 then date '1950-01-01' + cast(o_orderkey % 1000000 as int) end desc nulls last, gefus desc nulls last, fase desc) = 1),
e as (select apf, eo as eo_nome, cnpj as eo_cnpj, cast(b.k % 8 as int) as co_nivel_hab_eo, b.k % 13 = 0 as ic_substituicao_eo, case when b.k % 13 = 0 then '2022-03-04' end as dt_substituicao_eo, case when b.k % 13 = 0 then 'nova' end as eo_substituta_nome,
  case when b.k % 13 = 0 then '99' end as eo_substituta_cnpj, nome as empreendimento_nome, 'NÃO INFORMADO' as construtora_nome, '0' as construtora_cnpj, 'CAIXA' as agente_financeiro, greatest(uc, up) as quantidade_uh, uc as qt_uh_construcao,
  up as qt_uh_projeto, cast(floor(greatest(uc, up) * 3.3) as bigint) as pessoas_atendidas, cidade as municipio, estado as uf, cast(b.k % 5000 as varchar) as cod_ibge, tipo as co_tipo_edificacao,
  case tipo when 1 then 'Casa' when 2 then 'Misto' when 3 then 'Apartamento' else 'Não Informado' end as tipologia, reg as co_regime_obra, moda as co_modalidade, invest as valor_contratado, cast(b.k % 77 as double) as valor_financiamento_fds,
  0.0 as valor_contrapartidas, case when greatest(uc, up) > 0 then invest / greatest(uc, up) else 0.0 end as valor_por_uh, '2020-01-02' as dt_contratacao, case when b.k % 2 = 1 then '2020-01-12' end as dt_inicio_obra,
  '2023-01-01' as dt_previsao_conclusao, coalesce(gefus, 'Não mapeado') as situacao_gefus, coalesce(fase, 'Não mapeada') as fase_contrato, cast(b.k % 9 as int) as co_situacao_operacao, cast(b.k % 5 as int) as co_andamento_operacao,
  prev as percentual_obra_prevista, pct as percentual_execucao_fisica, 0 as qt_uh_concluidas, ali as qt_uh_alienadas, cast(b.k % 3 as int) as qt_uh_sem_habitese, 0 as qt_uh_construcao_parcial, 0 as qt_uh_ocupacao_irregular,
  case when greatest(uc, up) > 0 then {rounded("ali * 100.0 / greatest(uc, up)", 2)} else 0.0 end as pct_entrega, parada as dt_paralisacao, cast(null as int) as co_classificacao_paralisado, b.k % 17 = 0 as ic_invadido,
  case when b.k % 17 = 0 then '2021-07-08' end as dt_invasao, case when b.k % 19 = 0 then '2022-09-10' end as dt_conclusao_obra, cast(null as varchar) as dt_entrega, cast(null as varchar) as dt_previsao_entrega,
  cast(coalesce(v, 0) as double) as valor_desembolsado, coalesce(n, 0) as qt_liberacoes, strftime(ult, '%Y-%m-%d') as dt_ultima_liberacao, case when invest > 0 then {rounded("coalesce(v, 0) / invest * 100", 2)} else 0.0 end as percentual_execucao_financeira,
  case when invest > 0 then {rounded("coalesce(v, 0) / invest * 100 - pct", 2)} else 0.0 end as divergencia_fisico_financeira, cast(b.k % 2 as int) as co_situacao_trabalho_social, cast(b.k % 50 + 0.5 as double) as pct_execucao_ts,
  '2020-10-11' as dt_aprovacao_pts, cast(case when b.k % 2 = 1 then 10 end as int) as dias_contratacao_inicio, cast(nullif(grau, 0) as double) as gps_lat_grau, case when grau <> 0 then 12.5 end as gps_lat_minuto,
  case when grau <> 0 then 3.0 end as gps_lat_segundo, cast(-40 as double) as gps_long_grau, 1.0 as gps_long_minuto, cast(null as double) as gps_long_segundo from b left join paid using (k) left join snap using (k)),
curve as (select apf, eo_cnpj, eo_nome, mes, m.n as qt_liberacoes, cast(m.v as double) as vr_liberado_mes, cast(m.obra as double) as vr_pago_obra_mes, 0.0 as vr_pago_terreno_mes, 0.0 as vr_pago_pts_mes, 0.0 as vr_pago_projeto_mes,
  0.0 as vr_pago_incc_mes, 0.0 as vr_pago_aporte_mes, 0.0 as vr_pago_legalizacao_mes, 0.0 as vr_pago_seguranca_mes, cast(sum(m.v) over w as double) as vr_acumulado,
  case when valor_contratado > 0 then round(sum(m.v) over w / valor_contratado * 100, 2) else 0.0 end as pct_executado_financeiro, valor_contratado, municipio, uf
  from (select lpad(cast(o_custkey as varchar), 6, '0') || '03' as apf, cast(date_trunc('month', o_orderdate) as date) as mes, count(*) as n, sum(cast(round(o_totalprice) as bigint)) as v, sum(o_orderkey) as obra
    from orders where o_orderkey % 3 > 0 group by 1, 2) m join e using (apf) window w as (partition by apf order by mes)),
sheet as (select apf, upper(empreendimento_nome) as nome_empreendimento, eo_cnpj as cnpj_eo, left(eo_cnpj, 2) || '.' || substr(eo_cnpj, 3, 3) || '.' || substr(eo_cnpj, 6, 3) || '/' || substr(eo_cnpj, 9, 4) || '-' || right(eo_cnpj, 2) as cnpj_eo_formatado,
  upper(eo_nome) as nome_eo, agente_financeiro, quantidade_uh, pessoas_atendidas, tipologia, co_regime_obra,
  case co_regime_obra when 1 then 'Empreitada Global' when 2 then 'Autogestão' else 'Outro (' || coalesce(cast(co_regime_obra as varchar), 'N/A') || ')' end as regime_obra, co_modalidade,
  case co_modalidade when 1 then 'Aquisição de Terreno e Projeto' when 2 then 'Elaboração de Projeto' when 3 then 'Produção de Unidades Novas' when 4 then 'Requalificação' else 'Outro (' || coalesce(cast(co_modalidade as varchar), 'N/A') || ')' end as modalidade,
  municipio, uf, municipio || '/' || uf as municipio_uf, apf || ' - ' || municipio || '/' || uf || ' - ' || upper(empreendimento_nome) as apf_municipio_empreendimento, 'BR-' || uf as iso_3166_2,
  case uf when 'SP' then 'Sudeste' when 'PA' then 'Norte' when 'BA' then 'Nordeste' when 'GO' then 'Centro-Oeste' when 'RS' then 'Sul' else 'Não Informado' end as regiao_nome,
  gps_lat_grau, gps_lat_minuto, gps_lat_segundo, gps_long_grau, gps_long_minuto, gps_long_segundo, situacao_gefus,
  case when situacao_gefus = 'PARALISADA' then 'Paralisada' when situacao_gefus = 'NAO_INICIADA_CLAUSULA_SUSPENSIVA' then 'Cláusula Suspensiva' when percentual_execucao_fisica = 0 then 'Não Iniciada'
    when percentual_execucao_fisica = 100 then 'Concluída' else 'Em Andamento' end as semaforo_alerta, case when dt_paralisacao is not null then 'Sim' else 'Não' end as indicativo_paralisacao,
  valor_contratado, valor_financiamento_fds, valor_contrapartidas, valor_por_uh, dt_contratacao, valor_desembolsado, percentual_execucao_financeira, percentual_obra_prevista, percentual_execucao_fisica, dt_inicio_obra,
  dt_previsao_conclusao, dt_conclusao_obra, divergencia_fisico_financeira,
  case when divergencia_fisico_financeira > 5 then 'Desembolso Adiantado' when divergencia_fisico_financeira < -5 then 'Desembolso Atrasado' else 'Ritmo Equilibrado' end as status_ritmo_obra, qt_uh_alienadas, pct_entrega, dt_entrega,
  case when pct_entrega = 100 then 'Totalmente Entregue' when pct_entrega > 0 then 'Entrega Parcial' else 'Não Entregue' end as status_entrega, pct_execucao_ts from e)"""


def _raw_b(t):
    """Programme B's raw text tables by name."""
    k, ok = F.col("c_custkey"), F.col("o_orderkey")
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    apf = F.concat(F.lpad(_text(k), 6, "0"), F.lit("03")).alias("nu_apf")
    new = lambda value: F.when(k % 13 == 0, value)
    states = F.array(*map(F.lit, ["SP", "PA", "BA", "GO", "RS", "ZZ"]))
    register = c.select(
        apf, F.col("n_name").alias("no_eo"), F.concat(_text(F.col("c_nationkey") + 1), F.lit("/")).alias("nu_cnpj_eo"), _text(k % 8).alias("co_nivel_hab_eo"), new("S").alias("ic_substituicao_eo"),
        new("04/03/2022").alias("dt_substituicao_eo"), new(" nova").alias("no_substituicao_eo"), new("9/9").alias("nu_cnpj_substituicao_eo"), F.col("c_name").alias("no_empreendimento"),
        F.lit("NÃO INFORMADO").alias("no_construtora"), F.lit("0").alias("nu_cnpj_construtora"), F.lit("CAIXA ").alias("no_agente_financeiro"), F.concat(F.lit("M"), _text(k % 40)).alias("no_municipio"),
        F.get(states, (k % 6).cast("int")).alias("sg_uf"), _text(k % 5000).alias("co_municipio_ibge"), _text(k % 4).alias("co_tipo_edificacao"), _text(k % 3).alias("co_regime_obra"),
        F.when(k % 6 != 0, _text(k % 6)).alias("co_modalidade"), _text(k % 90).alias("nu_qt_uh_construcao"), _text(k % 70).alias("nu_qt_uh_projeto"), _br(F.round(F.abs("c_acctbal") * 100)).alias("vr_total_investimento"),
        _text(k % 77).alias("vr_financiamento_fds"), F.lit("02/01/2020").alias("dt_assinatura"), F.when(k % 2 == 0, "01/01/1900").otherwise("12/01/2020").alias("dt_inicio_obra"),
        F.lit("20230101").alias("dt_previsao_conclusao_obra"), _text(k % 10).alias("nu_gps_latitude_grau"), F.lit("12,5").alias("nu_gps_latitude_minuto"), F.lit("3").alias("nu_gps_latitude_segundo"),
        F.lit("-40").alias("nu_gps_longitude_grau"), F.lit("1").alias("nu_gps_longitude_minuto"), F.lit("").alias("nu_gps_longitude_segundo"),
    )
    works = c.select(
        apf, _text(k % 83).alias("pc_obra_prevista"), _text(k % 101).alias("pc_obra_realizada"), _text(k % 60).alias("qt_uh_alienada"), _text(k % 3).alias("qt_uh_sem_habitese"),
        F.when(k % 11 == 0, "20210101").alias("dt_paralisacao"), _text(k % 9).alias("co_situacao_operacao"), _text(k % 5).alias("co_andamento_operacao"), F.when(k % 17 == 0, "S").otherwise("N").alias("ic_invadido"),
        F.when(k % 17 == 0, "08/07/2021").alias("dt_invasao"), F.when(k % 19 == 0, "2022-09-10 00:00").alias("dt_conclusao_obra"),
    )
    root = F.lpad(_text(F.col("o_custkey")), 6, "0")
    orders = t("orders")
    status = F.when(ok % 5 == 0, "NORMAL").when(ok % 4 == 0, "PARALISADA").when(ok % 4 == 1, "NAO_INICIADA_CLAUSULA_SUSPENSIVA").when(ok % 4 == 2, "NORMAL").otherwise(" ")
    snapshot = orders.select(
        F.concat(root, F.lit("03")).alias("nu_apf"), F.when(F.col("o_orderstatus") != "P", "NOVO PMCMV-E").otherwise("X").alias("no_selecao_pmcmv_e"), status.alias("situacao_gefus"),
        F.concat(F.lit("fase "), _text(F.when(ok % 5 == 0, 0).otherwise(ok % 3))).alias("fase_contrato"), F.when(ok % 5 > 0, F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), (ok % 1_000_000).cast("int")), "yyyy-MM-dd")).alias("dt_movimento"),
    )
    sign = F.when(ok % 2 == 0, "-").otherwise("")
    paid = orders.select(
        root.alias("nu_apf"), F.when(ok % 3 > 0, "0").otherwise("1").alias("ic_credito"), F.concat(sign, _text(F.round("o_totalprice").cast("long"))).alias("vr_liberado"),
        F.concat(sign, _text(ok)).alias("vr_pago_obra_empreendimento"), _day("o_orderdate").alias("dt_liberacao_recurso"),
    )
    social = c.select(apf, _text(k % 2).alias("co_situacao_trabalho_social"), F.concat(_text(k % 50), F.lit(",5")).alias("pct_execucao_ts"), F.lit("11/10/2020").alias("dt_aprovacao_pts"))
    return {"register": register, "works": works, "snapshot": snapshot, "disbursements": paid, "social_work": social}


def _entity_b(t):
    typed = {name: P.bronze(frame, R.B[name]) for name, frame in _raw_b(t).items()}
    return typed, P.entity_b(typed["register"], typed["works"], typed["snapshot"], typed["social_work"], typed["disbursements"])


_DATES_B = "dt_substituicao_eo dt_contratacao dt_inicio_obra dt_previsao_conclusao dt_paralisacao dt_invasao dt_conclusao_obra dt_entrega dt_previsao_entrega dt_ultima_liberacao dt_aprovacao_pts"


@kit.query("p39_entity_b", f"with {_CLEAN_B} select * from e")
def _(t):
    return _told(_entity_b(t)[1], _DATES_B)


@kit.query("p40_cash_curve_b", f"with {_CLEAN_B} select * from curve", dates="mes")
def _(t):
    typed, entity = _entity_b(t)
    return P.cash_curve(typed["disbursements"], entity, P.AMOUNTS_B, credits_only=True, carry=["eo_cnpj", "eo_nome"])


@kit.query("p40_cash_chart_b", f"""
with {_CLEAN_B} select apf, eo_cnpj as cnpj_eo, upper(eo_nome) as nome_eo, apf_municipio_empreendimento, strftime(mes, '%Y-%m-%d') as mes, strftime(date_trunc('year', mes), '%Y-%m-%d') as ano,
  strftime(date_trunc('quarter', mes), '%Y-%m-%d') as trimestre, vr_liberado_mes as valor_liberado_mensal, vr_pago_obra_mes as valor_obra_mensal, vr_pago_terreno_mes as valor_terreno_mensal, vr_pago_pts_mes as valor_ts_mensal,
  vr_pago_projeto_mes as valor_projeto_mensal, vr_pago_incc_mes as valor_incc_mensal, vr_acumulado as valor_desembolsado_acumulado, pct_executado_financeiro as percentual_execucao_financeira, percentual_execucao_fisica,
  c.municipio, c.uf from curve c join sheet using (apf)""")
def _(t):
    typed, entity = _entity_b(t)
    entity = stash(entity, "entity-b")
    curve = P.cash_curve(typed["disbursements"], entity, P.AMOUNTS_B, credits_only=True, carry=["eo_cnpj", "eo_nome"])
    return P.cash_chart_b(curve, P.fact_sheet_b(entity))


@kit.query("p41_fact_sheet_b", f"with {_CLEAN_B} select * from sheet")
def _(t):
    return _told(P.fact_sheet_b(_entity_b(t)[1]), "dt_contratacao dt_inicio_obra dt_previsao_conclusao dt_conclusao_obra dt_entrega")


@kit.query("p42_organisation_panel", f"""
with {_CLEAN_B}, s as (select eo_cnpj as cnpj_eo, max(upper(eo_nome)) as nome_eo, count(*) as total_empreendimentos, cast(sum(quantidade_uh) as bigint) as total_uhs_contratadas, cast(sum(qt_uh_alienadas) as bigint) as total_uhs_entregues,
  cast(sum(pessoas_atendidas) as bigint) as total_pessoas_atendidas, sum(valor_contratado) as valor_total_contratado, sum(valor_desembolsado) as valor_total_desembolsado,
  case when sum(valor_contratado) > 0 then round(sum(percentual_execucao_fisica * valor_contratado) / sum(valor_contratado), 2) else 0.0 end as media_execucao_fisica,
  case when sum(valor_contratado) > 0 then round(sum(valor_desembolsado) / sum(valor_contratado) * 100, 2) else 0.0 end as media_execucao_financeira,
  case when sum(quantidade_uh) > 0 then round(sum(qt_uh_alienadas) * 100.0 / sum(quantidade_uh), 2) else 0.0 end as taxa_entrega_geral, count(*) filter (percentual_execucao_fisica < percentual_obra_prevista) as qtd_obras_atrasadas,
  count(dt_paralisacao) as qtd_obras_paralisadas, count(*) filter (divergencia_fisico_financeira < -5) as qtd_obras_divergencia_financeira, count(distinct uf) as qtd_estados_atuacao, count(distinct municipio) as qtd_municipios_atuacao
  from e group by 1)
select *, qtd_obras_atrasadas + 2 * qtd_obras_paralisadas + qtd_obras_divergencia_financeira as score_risco,
  case when qtd_obras_atrasadas + 2 * qtd_obras_paralisadas + qtd_obras_divergencia_financeira = 0 then 'Baixo Risco'
       when qtd_obras_atrasadas + 2 * qtd_obras_paralisadas + qtd_obras_divergencia_financeira <= 3 then 'Médio Risco' else 'Alto Risco' end as classificacao_risco from s""")
def _(t):
    return P.organisation_panel(_entity_b(t)[1])


@kit.query("p43_model_metadata", """
with runs as (
  select 'schema_' || o_orderpriority as schema_name, 'model_' || o_custkey % 50 as table_name, 'db' as database_name, 'table' as materialization, 'by ' || o_orderstatus as description, o_orderkey as k, 'run ' || o_orderkey as run_id,
    cast(o_orderdate as date) + interval 3 hour + to_minutes(cast(o_orderkey % 60 as int)) as started from orders),
told as (select * exclude (k, started), strftime((started at time zone 'UTC') at time zone 'America/Sao_Paulo', '%Y-%m-%d %H:%M:%S') as dt_transform, started, k from runs)
select * exclude (started, k) from told qualify row_number() over (partition by schema_name, table_name order by started desc, k desc) = 1""")
def _(t):
    o = t("orders")
    started = F.timestamp_add("MINUTE", 180 + F.col("o_orderkey") % 60, F.col("o_orderdate").cast("date").cast("timestamp"))
    runs = o.select(
        F.concat(F.lit("schema_"), "o_orderpriority").alias("schema_name"), F.concat(F.lit("model_"), _text(F.col("o_custkey") % 50)).alias("table_name"), F.lit("db").alias("database_name"),
        F.lit("table").alias("materialization"), F.concat(F.lit("by "), "o_orderstatus").alias("description"), started.alias("executed_at"), F.concat(F.lit("run "), _text(F.col("o_orderkey"))).alias("run_id"), "o_orderkey",
    )
    # a store of older runs, and the newer ones of which each model keeps the last
    newest = P.T.latest_per_key(runs, ["schema_name", "table_name"], ["executed_at", "o_orderkey"]).drop("o_orderkey")
    older = newest.select("schema_name", "table_name", F.lit("gone").alias("run_id"), F.lit("1990-01-01").cast("timestamp").alias("executed_at"))
    found = P.model_metadata(older, newest).withColumn("dt_transform", F.date_format("executed_at", "yyyy-MM-dd HH:mm:ss")).drop("executed_at")
    return found.select("schema_name", "table_name", "database_name", "materialization", "description", "run_id", "dt_transform")

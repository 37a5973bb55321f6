"""Housing-programme pipelines: registers, works and disbursements to entities, curves, fact sheets and panels.

Programme A and B differ in sources and rules, not in shape; what they share is written once. ``as_of`` stands for
the day of the report, ``states`` has ``sigla, nome, regiao_sigla, regiao_nome``.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marajo.functions import cleaning as C
from marajo.operators import checks as Q
from marajo.operators import tables as T
from marajo.plans.programme_tables import TYPES


def bronze(raw: DataFrame, table: Sequence[tuple[list[str], str, str]], only: Collection[str] | None = None) -> DataFrame:
    """P30, P38. Text columns to typed ones, row by row; columns the raw table lacks are null before they are typed.

    ``only`` names the typed columns that are wanted. Those that nobody reads would be pruned anyway, but a plan of a hundred
    of them takes seconds to make.
    """
    lacking, has = F.lit(None).cast("string"), set(raw.columns)
    typed = lambda names, kind: F.coalesce(*[TYPES[kind](F.col(n) if n in has else lacking) for n in names])
    return raw.select(*[typed(names, kind).alias(name) for names, name, kind in table if only is None or name in only])


def priority_of(snapshot: DataFrame, programme: str = "FAR") -> DataFrame:
    """P30. The lender's typed snapshot, of one programme."""
    return snapshot.where(F.col("modalidade") == programme)


def _zero(name: str, kind: str = "double") -> Column:
    return F.coalesce(F.col(name).cast(kind), F.lit(0).cast(kind))


def _place() -> list[Column]:
    """Place and search labels that all sheets have; null parts are left empty."""
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    return [
        F.concat(part("municipio"), F.lit("/"), part("uf")).alias("municipio_uf"),
        C.search_label("apf", "municipio", "uf", "empreendimento_nome").alias("apf_municipio_empreendimento"),
    ]


# --- programme A --------------------------------------------------------------------------------------------

#: Codes of building types, of origination and of demand, and the labels they have in the reports. Fixed values.
BUILDINGS_A = {"1": "Casa Térrea", "2": "Apartamento", "3": "Sobrado", "4": "Misto"}
METHODS = {"1": "SELEÇÃO", "2": "CALAMIDADE/EMERGÊNCIA"}
DEMANDS = {
    "1": "CADASTRO HABITACIONAL", "2": "MOVIMENTOS SOCIAIS", "3": "CALAMIDADE", "4": "OBRA PÚBLICA", "5": "REASSENTAMENTO", "6": "DOAÇÃO/CESSÃO DE TERRENO", "7": "OUTROS",
}


def entity_a(register: DataFrame, proposals: DataFrame, works: DataFrame, priority: DataFrame) -> DataFrame:
    """P31. One row per contract: register, the latest proposal (null dates first, as its source has it; of equal dates
    the greatest by the other columns in turn), works and the lender's snapshot."""
    order = ["dt_movimento", "dt_protocolo"]
    taken = ["id_proposta", "portaria_contratacao", "proponente_cnpj", "proponente_nome", "tomador_cnpj", "tomador_nome", "municipio", "uf", "co_originacao", "co_tipo_demanda"]
    latest = T.latest_per_key(proposals.where("id_proposta is not null").select(*taken, *order), "id_proposta", [*order, *taken[1:]], nulls="first").select(*taken)
    own = register.select("apf", "id_proposta", "empreendimento_nome", "qt_uh", "co_tipo_edificacao", "vr_total_investimento", "agente_financeiro", "dt_contratacao")
    star = T.enrich(
        own,
        [(latest, "id_proposta"), (works.select("apf", "pct_obra_realizada", "dt_conclusao_obra", "dt_entrega"), "apf"),
         (priority.select("apf", "situacao", "pct_execucao", "valor_desembolsado", "valor_aporte_adicional", "dt_previsao_entrega"), "apf")],
        checked=False,
    )
    return star.select(
        "apf", F.coalesce("portaria_contratacao", F.lit("Não informada")).alias("portaria_selecao"), "proponente_cnpj", "proponente_nome", "tomador_cnpj", "tomador_nome",
        "empreendimento_nome", F.col("qt_uh").alias("quantidade_uh"), "municipio", "uf", "co_originacao", "co_tipo_demanda",
        F.coalesce("situacao", F.lit("Situação não mapeada")).alias("situacao_empreendimento"), F.col("co_tipo_edificacao").alias("codigo_tipologia"),
        C.decode("co_tipo_edificacao", BUILDINGS_A, "Não Informado").alias("tipologia"), C.scaled_floor("qt_uh").alias("pessoas_atendidas"),
        _zero("vr_total_investimento").alias("valor_contratado"), "agente_financeiro", "dt_contratacao", _zero("valor_aporte_adicional").alias("valor_aporte_adicional"),
        C.safe_ratio("vr_total_investimento", F.coalesce("qt_uh", F.lit(0))).alias("valor_por_uh"),
        F.coalesce(F.col("pct_obra_realizada").cast("double"), F.col("pct_execucao").cast("double"), F.lit(0.0)).alias("percentual_execucao_fisica"),
        "dt_conclusao_obra", "dt_entrega", "dt_previsao_entrega", _zero("valor_desembolsado").alias("valor_desembolsado"),
        C.safe_ratio(_zero("valor_desembolsado"), _zero("vr_total_investimento"), 100).alias("percentual_execucao_financeira"),
    )


#: Amounts of the cash curves: report name to typed column.
AMOUNTS_A = {
    "vr_liberado_mes": "vr_liberado", "vr_pago_obra_mes": "vr_pago_obra", "vr_pago_terreno_mes": "vr_pago_terreno", "vr_pago_pts_mes": "vr_pago_trabalho_social",
    "vr_pago_incc_mes": "vr_pago_incc", "vr_pago_aporte_mes": "vr_pago_aporte", "vr_pago_equipamentos_mes": "vr_pago_equipamentos", "vr_pago_manutencao_mes": "vr_pago_manutencao",
    "vr_pago_legalizacao_mes": "vr_pago_legalizacao",
}
AMOUNTS_B = {
    "vr_liberado_mes": "vr_liberado", "vr_pago_obra_mes": "vr_pago_obra", "vr_pago_terreno_mes": "vr_pago_terreno", "vr_pago_pts_mes": "vr_pago_trabalho_social",
    "vr_pago_projeto_mes": "vr_pago_projeto", "vr_pago_incc_mes": "vr_pago_incc", "vr_pago_aporte_mes": "vr_pago_aporte", "vr_pago_legalizacao_mes": "vr_pago_legalizacao",
    "vr_pago_seguranca_mes": "vr_pago_seguranca",
}


#: Typed columns of the raw tables that the pipelines of a programme read.
READ_A = {
    "register": ["apf", "id_proposta", "empreendimento_nome", "qt_uh", "co_tipo_edificacao", "vr_total_investimento", "agente_financeiro", "dt_contratacao"],
    "proposals": [
        "id_proposta", "portaria_contratacao", "proponente_cnpj", "proponente_nome", "tomador_cnpj", "tomador_nome", "municipio", "uf", "co_originacao", "co_tipo_demanda", "dt_movimento", "dt_protocolo",
    ],
    "works": ["apf", "pct_obra_realizada", "dt_alteracao_situacao", "dt_conclusao_obra", "dt_entrega"],
    "priority": ["apf", "modalidade", "situacao", "pct_execucao", "valor_desembolsado", "valor_aporte_adicional", "dt_previsao_entrega"],
    "disbursements": ["apf", "ic_credito", "dt_liberacao", *AMOUNTS_A.values()],
}


def cash_curve(disbursements: DataFrame, entity: DataFrame, amounts: Mapping[str, str] = AMOUNTS_A, credits_only: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """P32, P40. Monthly disbursements by contract joined on six-digit roots, accumulated, as percent of the contract.

    Programme B counts credits only (type ``0``), takes signed amounts as absolute and carries the organisation.
    """
    rows = disbursements.select("apf", "ic_credito", "dt_liberacao", *[F.col(c).cast("double").alias(n) for n, c in amounts.items()])
    if credits_only:
        rows = T.credits_absolute(rows.where("vr_liberado_mes is not null"), "ic_credito", list(amounts), "0")
    monthly = T.monthly_totals(rows.withColumn("root", F.right("apf", F.lit(6))).drop("apf"), ["root"], "dt_liberacao", list(amounts))
    joined = T.join_on_root(monthly, entity.select("apf", *carry, "valor_contratado", "municipio", "uf"), F.col("root"), F.left("apf", F.lit(6))).drop("root")
    return T.cumulative_progress(joined, "apf", "month", "vr_liberado_mes", "valor_contratado").select(
        "apf", *carry, F.col("month").alias("mes"), F.col("n").alias("qt_liberacoes"), *amounts, F.col("accumulated").alias("vr_acumulado"),
        F.col("progress").alias("pct_executado_financeiro"), "valor_contratado", "municipio", "uf",
    )


def cash_chart_a(curve: DataFrame, sheet: DataFrame, states: DataFrame) -> DataFrame:
    """P32 chart. Programme A's curve with the sheet's names, the state's name and labels of the month."""
    names = sheet.select("apf", "nome_empreendimento", "apf_municipio_empreendimento")
    star = T.enrich(curve, [(names, "apf"), (states.select(F.col("sigla").alias("uf"), F.upper("nome").alias("estado")), "uf")], checked=False)
    label = C.date_labels("mes")
    two = [*list(AMOUNTS_A)[:5], "vr_acumulado", "valor_contratado"]
    return star.select(
        "apf", "nome_empreendimento", "apf_municipio_empreendimento", "municipio", "uf", "estado", "mes", label["year_month"].alias("mes_label"), label["month_year"].alias("mes_label_br"),
        "qt_liberacoes", *[F.round(c, 2).alias(c) for c in two], "pct_executado_financeiro",
    )


def cash_chart_b(curve: DataFrame, sheet: DataFrame) -> DataFrame:
    """P40 chart. Programme B's curve under report names, with the physical progress of its sheet."""
    star = T.enrich(curve, [(sheet.select("apf", "apf_municipio_empreendimento", "percentual_execucao_fisica"), "apf")], checked=False)
    label = C.date_labels("mes")
    names = {"liberado": "liberado", "pago_obra": "obra", "pago_terreno": "terreno", "pago_pts": "ts", "pago_projeto": "projeto", "pago_incc": "incc"}
    return star.select(
        "apf", F.col("eo_cnpj").alias("cnpj_eo"), F.upper("eo_nome").alias("nome_eo"), "apf_municipio_empreendimento", F.date_format("mes", "yyyy-MM-dd").alias("mes"),
        label["year"].alias("ano"), label["quarter"].alias("trimestre"), *[F.col(f"vr_{c}_mes").alias(f"valor_{n}_mensal") for c, n in names.items()],
        F.col("vr_acumulado").alias("valor_desembolsado_acumulado"), F.col("pct_executado_financeiro").alias("percentual_execucao_financeira"),
        _zero("percentual_execucao_fisica").alias("percentual_execucao_fisica"), "municipio", "uf",
    )


def physical_against_financial(curve: DataFrame, works: DataFrame, entity: DataFrame) -> DataFrame:
    """P33. Both progress series of a contract over the months of either, carried forward, leading gaps 0."""
    financial = curve.select("apf", "mes", "pct_executado_financeiro")
    month = F.trunc("dt_alteracao_situacao", "month").alias("mes")
    done = F.max(F.col("pct_obra_realizada").cast("double")).alias("pct_obra_realizada")
    physical = works.where("dt_alteracao_situacao is not null").groupBy("apf", month).agg(done)
    filled = T.locf(T.full_outer_coalesce(financial, physical, ["apf", "mes"]), "apf", "mes", ["pct_obra_realizada", "pct_executado_financeiro"])
    named = T.enrich(filled, [(entity.select("apf", "municipio", "uf", "empreendimento_nome"), "apf")], checked=False)
    return named.select("apf", _place()[1], F.date_format("mes", "yyyy-MM-dd").alias("mes"), "pct_obra_realizada", "pct_executado_financeiro")


def fact_sheet_a(entity: DataFrame, as_of: str) -> DataFrame:
    """P34. The entity under report names, with labels, decoded method and demand, and the status classes."""
    told = T.classify_status(
        entity.withColumns({
            "physical": F.col("percentual_execucao_fisica"), "financial": F.col("percentual_execucao_financeira"), "due": F.col("dt_previsao_entrega"),
            "delivered": F.col("situacao_empreendimento") == "ENTREGUE",
        }), as_of,
    )
    label = lambda c, names: F.map_from_entries(F.array(*[F.struct(F.lit(k), F.lit(v)) for k, v in names.items()]))[F.col(c)]
    return told.select(
        "apf", "portaria_selecao", F.upper("empreendimento_nome").alias("nome_empreendimento"), "proponente_cnpj", F.upper("proponente_nome").alias("nome_proponente"), "tomador_cnpj",
        F.upper("tomador_nome").alias("nome_tomador"), "agente_financeiro", "quantidade_uh", "pessoas_atendidas", "tipologia", "municipio", "uf", *_place(),
        C.decode("co_originacao", METHODS).alias("metodo"), C.decode("co_tipo_demanda", DEMANDS, "NÃO IDENTIFICADO ({})").alias("demanda"), "situacao_empreendimento",
        label("execution", {"complete": "Concluído", "not started": "Não Iniciado", "in progress": "Em Andamento", "unknown": "Status Desconhecido"}).alias("status_execucao_simplificado"),
        "valor_contratado", "valor_aporte_adicional", "valor_por_uh", "dt_contratacao", "percentual_execucao_fisica", "dt_previsao_entrega", "dt_conclusao_obra", "dt_entrega",
        label("deadline", {"late": "Em Atraso", "delivered": "Entregue", "in time": "Dentro do Prazo"}).alias("status_prazo"), "valor_desembolsado", "percentual_execucao_financeira",
        label("pace", {"money ahead": "Desembolso Adiantado", "money behind": "Desembolso Atrasado", "balanced": "Ritmo Equilibrado"}).alias("ritmo_fisico_financeiro"),
    )


def national_map(sheets: DataFrame, states: DataFrame) -> DataFrame:
    """P35. KPIs by state and, added up from the state rows (averages averaged), by region; names are joined to the
    aggregated rows."""
    units = sheets.groupBy("uf").agg(
        F.count_distinct("municipio_uf").alias("total_municipios"), F.count("apf").alias("total_empreendimentos"), F.coalesce(F.sum("quantidade_uh"), F.lit(0)).alias("total_uhs"),
        F.coalesce(F.sum("valor_contratado"), F.lit(0.0)).alias("total_valor_contratado"), F.coalesce(F.sum("valor_desembolsado"), F.lit(0.0)).alias("total_valor_desembolsado"),
        F.coalesce(F.avg("percentual_execucao_fisica"), F.lit(0.0)).alias("media_execucao_fisica"),
    )
    sums = ["total_municipios", "total_empreendimentos", "total_uhs", "total_valor_contratado", "total_valor_desembolsado"]
    units = T.enrich(units, [(states.select(F.col("sigla").alias("uf"), F.col("nome").alias("estado_nome"), "regiao_sigla", "regiao_nome"), "uf")], checked=False)
    regions = units.groupBy("regiao_sigla", "regiao_nome").agg(*[F.sum(c).alias(c) for c in sums], F.avg("media_execucao_fisica").alias("media_execucao_fisica"))
    shaped = lambda df, uf, name, iso, level: df.select(
        uf.alias("uf"), name.alias("estado_nome"), iso.alias("iso_3166_2"), "regiao_sigla", "regiao_nome", F.lit(level).alias("nivel"), *sums,
        F.round("media_execucao_fisica", 1).alias("media_execucao_fisica"),
    )
    own = shaped(units, F.col("uf"), F.col("estado_nome"), C.iso_state("uf"), "uf")
    return own.unionByName(shaped(regions, F.col("regiao_sigla"), F.col("regiao_nome"), F.lit(None).cast("string"), "regiao"))


#: Situations of the state panel, in report order, and its bands of physical execution. Fixed values.
SITUATIONS = ["CONCLUÍDO E ENTREGUE", "CONCLUÍDO", "EM ANDAMENTO", "PARALISADO", "NÃO INICIADO", "DESMOBILIZADO"]
EXECUTION_BANDS = ([40, 55, 75], ["Menor que 40%", "De 41% a 55%", "De 56% a 75%", "Maior que 75%"])


def state_panel(sheets: DataFrame, states: DataFrame, situations: Sequence[str] = SITUATIONS) -> DataFrame:
    """P36. Sections of one long table by state: header, method, ordinance, demand, situation (all listed ones, zeros
    included) and bands of physical execution. The header reuses the counts for municipalities and units."""
    ordinance = F.when(F.col("portaria_selecao") == "Não informada", F.col("portaria_selecao")).otherwise(F.concat(F.lit("Portaria nº "), "portaria_selecao"))
    labels = EXECUTION_BANDS[1]
    parts = {
        "metodo": F.col("metodo"), "portaria": ordinance, "demanda": F.col("demanda"), "situacao": F.col("situacao_empreendimento"),
        "execucao_fisica": T.band(F.col("percentual_execucao_fisica"), *EXECUTION_BANDS),
    }
    # the sections are one measure by section and dimension: a sheet is read once and counts in each, the header beside them
    sections = F.array(*[F.struct(F.lit(n).alias("section"), c.cast("string").alias("dimensao")) for n, c in parts.items()], F.struct(F.lit("header").alias("section"), F.lit("resumo").alias("dimensao")))
    long = sheets.select("uf", "apf", "municipio", "quantidade_uh", "valor_contratado", "valor_desembolsado", "valor_aporte_adicional", F.inline(sections))
    header = F.col("section") == "header"
    only = lambda c: F.when(header, c)
    units, amount = F.coalesce(F.sum("quantidade_uh"), F.lit(0)), lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    counted = long.groupBy("uf", "section", "dimensao").agg(
        F.when(header, F.size(F.collect_set(only(F.col("municipio"))))).otherwise(F.count("apf")).cast("long").alias("qtd_empreendimentos"), units.alias("qtd_uhs"),
        only(amount("valor_contratado")).alias("valor_1"), only(amount("valor_desembolsado")).alias("valor_2"), only(amount("valor_aporte_adicional")).alias("valor_3"),
        only(F.when(units > 0, F.sum("valor_contratado") / F.sum("quantidade_uh")).otherwise(0.0)).alias("valor_4"),
        only(F.count("apf")).alias("total_empreendimentos_uf"),
    )
    # every state has a row for each listed situation, one whose situations are all unlisted too: the header's row brings them
    listed = F.array(*[F.lit(x) for x in situations])
    zeros = lambda s: F.struct(F.lit("situacao").alias("section"), s.alias("dimensao"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("u"))
    own = F.struct("section", "dimensao", F.col("qtd_empreendimentos").alias("n"), F.col("qtd_uhs").cast("long").alias("u"))
    spread = counted.withColumn("row", F.explode(F.when(header, F.concat(F.array(own), F.transform(listed, zeros))).otherwise(F.array(own))))
    summed = spread.where((F.col("row.section") != "situacao") | F.array_contains(listed, F.col("row.dimensao"))).groupBy("uf", "row.section", "row.dimensao").agg(
        F.sum("row.n").alias("qtd_empreendimentos"), F.sum("row.u").alias("qtd_uhs"),
        *[F.max(F.when(F.col("row.section") == "header", F.col(c))).alias(c) for c in ("valor_1", "valor_2", "valor_3", "valor_4", "total_empreendimentos_uf")],
    )
    place = lambda names: F.array_position(F.array(*[F.lit(x) for x in names]), F.col("dimensao")).cast("int")
    panel = summed.withColumn("position", F.when(F.col("section") == "situacao", place(situations)).when(F.col("section") == "execucao_fisica", place(labels)))
    named = T.enrich(panel, [(states.select(F.col("sigla").alias("uf"), F.upper("nome").alias("estado")), "uf")], checked=False)
    return named.select(
        "uf", "estado", F.col("section").alias("secao"), "dimensao", F.coalesce("position", F.lit(0)).alias("ordem"), "qtd_empreendimentos", "qtd_uhs",
        "valor_1", "valor_2", "valor_3", "valor_4", "total_empreendimentos_uf",
    )


def management_summary(sheets: DataFrame) -> DataFrame:
    """P37. Totals and averages by situation, typology, and status of execution and deadline."""
    return sheets.groupBy("situacao_empreendimento", "tipologia", "status_execucao_simplificado", "status_prazo").agg(
        F.count("apf").alias("total_empreendimentos"), F.sum("quantidade_uh").alias("total_uhs"), F.sum("pessoas_atendidas").alias("total_pessoas_atendidas"),
        F.sum("valor_contratado").alias("somatorio_valor_contratado"), F.sum("valor_desembolsado").alias("somatorio_valor_desembolsado"),
        F.avg("percentual_execucao_fisica").alias("media_execucao_fisica"), F.avg("valor_por_uh").alias("media_valor_por_uh"),
    )


# --- programme B --------------------------------------------------------------------------------------------

#: Codes of building types, work regimes and modalities, and the regions' states. Fixed values.
BUILDINGS_B = {"1": "Casa", "2": "Misto", "3": "Apartamento"}
REGIMES = {"1": "Empreitada Global", "2": "Autogestão"}
MODALITIES = {"1": "Aquisição de Terreno e Projeto", "2": "Elaboração de Projeto", "3": "Produção de Unidades Novas", "4": "Requalificação"}
REGIONS = {
    "Norte": ["AC", "AP", "AM", "PA", "RO", "RR", "TO"], "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"], "Centro-Oeste": ["DF", "GO", "MT", "MS"],
    "Sudeste": ["ES", "MG", "RJ", "SP"], "Sul": ["PR", "RS", "SC"],
}
_GPS = [f"gps_{axis}_{part}" for axis in ("lat", "long") for part in ("grau", "minuto", "segundo")]


def entity_b(register: DataFrame, works: DataFrame, snapshot: DataFrame, social: DataFrame, disbursements: DataFrame, selection: str = "NOVO PMCMV-E") -> DataFrame:
    """P39. One row per contract of programme B: register, works, the latest snapshot of the selection (null dates last,
    of equal dates the greatest by situation, then phase), social work, and absolute credits by six-digit root. Coordinates of zero degrees are none."""
    taken = snapshot.where(F.col("selecao_pmcmv_e") == selection).select("apf", "situacao_gefus", "fase_contrato", "dt_movimento")
    latest = T.latest_per_key(taken, "apf", ["dt_movimento", "situacao_gefus", "fase_contrato"]).drop("dt_movimento")
    credits = T.credits_absolute(disbursements.where("vr_liberado is not null"), "ic_credito", ["vr_liberado"], "0")
    paid = credits.groupBy(F.right("apf", F.lit(6)).alias("_root")).agg(
        F.sum(F.col("vr_liberado").cast("double")).alias("paid"), F.count(F.lit(1)).alias("qt_liberacoes"), F.max("dt_liberacao").alias("dt_ultima_liberacao")
    )
    done_columns = [
        "co_situacao_operacao", "co_andamento_operacao", "pct_obra_prevista", "pct_obra_realizada", "qt_uh_concluidas", "qt_uh_alienadas", "qt_uh_sem_habitese", "qt_uh_construcao_parcial",
        "qt_uh_ocupacao_irregular", "dt_paralisacao", "co_classificacao_paralisado", "ic_invadido", "dt_invasao", "dt_conclusao_obra", "dt_entrega", "dt_previsao_entrega",
    ]
    own = [
        "apf", "eo_nome", "eo_cnpj", "co_nivel_hab_eo", "ic_substituicao_eo", "dt_substituicao_eo", "eo_substituta_nome", "eo_substituta_cnpj", "empreendimento_nome", "construtora_nome",
        "construtora_cnpj", "agente_financeiro", "qt_uh_construcao", "qt_uh_projeto", "municipio", "uf", "cod_ibge", "co_tipo_edificacao", "co_regime_obra", "co_modalidade",
        "vr_total_investimento", "vr_financiamento_fds", "vr_total_contrapartidas", "dt_contratacao", "dt_inicio_obra", "dt_previsao_conclusao", *_GPS,
    ]
    star = T.enrich(
        register.select(*own, F.left("apf", F.lit(6)).alias("_root")),
        [(works.select("apf", *done_columns), "apf"), (latest, "apf"), (social.select("apf", "co_situacao_trabalho_social", "pct_execucao_ts", "dt_aprovacao_pts"), "apf"), (paid, "_root")],
        checked=False,
    )
    units = F.greatest(_zero("qt_uh_construcao", "int"), _zero("qt_uh_projeto", "int"))
    contract, spent, done = _zero("vr_total_investimento"), _zero("paid"), _zero("pct_obra_realizada")
    count = lambda c: _zero(c, "int").alias(c)
    gps = [F.when(F.col(f"gps_{'lat' if '_lat_' in c else 'long'}_grau") != 0, F.col(c)).alias(c) for c in _GPS]
    return star.select(
        "apf", "eo_nome", C.pad_cnpj("eo_cnpj").alias("eo_cnpj"), "co_nivel_hab_eo", "ic_substituicao_eo", "dt_substituicao_eo", "eo_substituta_nome", "eo_substituta_cnpj",
        "empreendimento_nome", "construtora_nome", "construtora_cnpj", "agente_financeiro", units.alias("quantidade_uh"), "qt_uh_construcao", "qt_uh_projeto",
        C.scaled_floor(units).alias("pessoas_atendidas"), "municipio", "uf", "cod_ibge", "co_tipo_edificacao", C.decode("co_tipo_edificacao", BUILDINGS_B, "Não Informado").alias("tipologia"),
        "co_regime_obra", "co_modalidade", contract.alias("valor_contratado"), _zero("vr_financiamento_fds").alias("valor_financiamento_fds"),
        _zero("vr_total_contrapartidas").alias("valor_contrapartidas"), C.safe_ratio("vr_total_investimento", units).alias("valor_por_uh"),
        C.null_date_sentinel("dt_contratacao").alias("dt_contratacao"), C.null_date_sentinel("dt_inicio_obra").alias("dt_inicio_obra"), "dt_previsao_conclusao",
        F.coalesce("situacao_gefus", F.lit("Não mapeado")).alias("situacao_gefus"), F.coalesce("fase_contrato", F.lit("Não mapeada")).alias("fase_contrato"),
        "co_situacao_operacao", "co_andamento_operacao", _zero("pct_obra_prevista").alias("percentual_obra_prevista"), done.alias("percentual_execucao_fisica"),
        *[count(c) for c in ("qt_uh_concluidas", "qt_uh_alienadas", "qt_uh_sem_habitese", "qt_uh_construcao_parcial", "qt_uh_ocupacao_irregular")],
        C.safe_ratio(_zero("qt_uh_alienadas", "int"), units, 100, digits=2).alias("pct_entrega"), "dt_paralisacao", "co_classificacao_paralisado", "ic_invadido", "dt_invasao",
        "dt_conclusao_obra", "dt_entrega", "dt_previsao_entrega", spent.alias("valor_desembolsado"), _zero("qt_liberacoes", "long").alias("qt_liberacoes"), "dt_ultima_liberacao",
        C.safe_ratio(spent, contract, 100, digits=2).alias("percentual_execucao_financeira"),
        F.when(contract > 0, F.round(spent / contract * 100 - done, 2)).otherwise(0.0).alias("divergencia_fisico_financeira"),
        "co_situacao_trabalho_social", F.col("pct_execucao_ts").cast("double").alias("pct_execucao_ts"), "dt_aprovacao_pts",
        C.days_between("dt_inicio_obra", "dt_contratacao").alias("dias_contratacao_inicio"), *gps,
    )


def fact_sheet_b(entity: DataFrame, regions: Mapping[str, Sequence[str]] = REGIONS) -> DataFrame:
    """P41. The entity under report names, with masked tax id, decoded regime and modality, region, alert, pace and
    delivery classes."""
    gap, done = F.col("divergencia_fisico_financeira"), F.col("percentual_execucao_fisica")
    alert = (
        F.when(F.col("situacao_gefus") == "PARALISADA", "Paralisada").when(F.col("situacao_gefus") == "NAO_INICIADA_CLAUSULA_SUSPENSIVA", "Cláusula Suspensiva")
        .when(done == 0, "Não Iniciada").when(done == 100, "Concluída").otherwise("Em Andamento")
    )
    return entity.select(
        "apf", F.upper("empreendimento_nome").alias("nome_empreendimento"), F.col("eo_cnpj").alias("cnpj_eo"), C.format_cnpj("eo_cnpj").alias("cnpj_eo_formatado"),
        F.upper("eo_nome").alias("nome_eo"), "agente_financeiro", "quantidade_uh", "pessoas_atendidas", "tipologia", "co_regime_obra",
        C.decode("co_regime_obra", REGIMES, "Outro ({})").alias("regime_obra"), "co_modalidade", C.decode("co_modalidade", MODALITIES, "Outro ({})").alias("modalidade"),
        "municipio", "uf", *_place(), C.iso_state(F.coalesce("uf", F.lit(""))).alias("iso_3166_2"), C.bucket("uf", regions, "Não Informado").alias("regiao_nome"), *_GPS,
        "situacao_gefus", alert.alias("semaforo_alerta"), F.when(F.col("dt_paralisacao").isNotNull(), "Sim").otherwise("Não").alias("indicativo_paralisacao"),
        "valor_contratado", "valor_financiamento_fds", "valor_contrapartidas", "valor_por_uh", "dt_contratacao", "valor_desembolsado", "percentual_execucao_financeira",
        "percentual_obra_prevista", "percentual_execucao_fisica", "dt_inicio_obra", "dt_previsao_conclusao", "dt_conclusao_obra", "divergencia_fisico_financeira",
        F.when(gap > 5, "Desembolso Adiantado").when(gap < -5, "Desembolso Atrasado").otherwise("Ritmo Equilibrado").alias("status_ritmo_obra"),
        "qt_uh_alienadas", "pct_entrega", "dt_entrega",
        F.when(F.col("pct_entrega") == 100, "Totalmente Entregue").when(F.col("pct_entrega") > 0, "Entrega Parcial").otherwise("Não Entregue").alias("status_entrega"), "pct_execucao_ts",
    )


def organisation_panel(entity: DataFrame) -> DataFrame:
    """P42. KPIs, weighted averages and risk by organisation."""
    late = F.col("percentual_execucao_fisica") < F.col("percentual_obra_prevista")
    sums = entity.groupBy(F.col("eo_cnpj").alias("cnpj_eo")).agg(
        F.max(F.upper("eo_nome")).alias("nome_eo"), F.count("apf").alias("total_empreendimentos"), F.sum("quantidade_uh").alias("total_uhs_contratadas"),
        F.sum("qt_uh_alienadas").alias("total_uhs_entregues"), F.sum("pessoas_atendidas").alias("total_pessoas_atendidas"), F.sum("valor_contratado").alias("valor_total_contratado"),
        F.sum("valor_desembolsado").alias("valor_total_desembolsado"), T.weighted_avg(F.col("percentual_execucao_fisica"), F.col("valor_contratado")).alias("media_execucao_fisica"),
        T.ratio_of_sums(F.col("valor_desembolsado"), F.col("valor_contratado")).alias("media_execucao_financeira"),
        T.ratio_of_sums(F.col("qt_uh_alienadas"), F.col("quantidade_uh")).alias("taxa_entrega_geral"), F.count_if(late).alias("qtd_obras_atrasadas"),
        F.count_if(F.col("dt_paralisacao").isNotNull()).alias("qtd_obras_paralisadas"), F.count_if(F.col("divergencia_fisico_financeira") < -5).alias("qtd_obras_divergencia_financeira"),
        F.count_distinct("uf").alias("qtd_estados_atuacao"), F.count_distinct("municipio").alias("qtd_municipios_atuacao"),
    )
    scored = T.risk_score(sums, {"qtd_obras_atrasadas": 1, "qtd_obras_paralisadas": 2, "qtd_obras_divergencia_financeira": 1}, [(0, "Baixo Risco"), (3, "Médio Risco")], "Alto Risco")
    return scored.withColumnsRenamed({"risk_score": "score_risco", "risk_class": "classificacao_risco"})


def model_metadata(store: DataFrame, runs: DataFrame) -> DataFrame:
    """P43. Metadata of model runs by schema and table, the newest of each, run times in local time."""
    return Q.record_model_metadata(store, runs.withColumn("executed_at", C.local_run_time("executed_at")))

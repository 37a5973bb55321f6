"""Keyed loads: upsert, refresh, deduplication, schema evolution, naming, stamps, windows of extraction."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marajo.session import stash

NAME_LIMIT = 57


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; null keys are equal to each other."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedupe_keep_first(df: DataFrame, cols: Sequence[str], order: str) -> DataFrame:
    """The first row by ``order`` of each group of equal columns."""
    return pick_one(df, cols, [F.col(order)])


def dedupe_batch(df: DataFrame, keys: Sequence[str], order: str, keep: str = "first", fill: Mapping[str, str] | None = None) -> DataFrame:
    """One row per key, first or last seen; ``fill`` gives key columns a default first."""
    filled = df.fillna(dict(fill)) if fill else df
    return pick_one(filled, keys, [F.col(order) if keep == "first" else F.col(order).desc()])


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: str | None = None, on_batch_duplicate: str = "last") -> DataFrame:
    """``target`` with the batch's rows in place of those of equal keys; new columns are added, null for old rows.

    A key that stands twice in the batch is an error, or its last row by ``order`` wins. Rows with a null key never
    conflict: they are inserted.
    """
    if on_batch_duplicate == "error":
        if batch.groupBy(*keys).count().where("count > 1").take(1):
            raise ValueError(f"the batch repeats a key of {list(keys)}")
        fresh = batch
    else:
        if order is None:
            raise ValueError("last wins needs an order column")
        keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        fresh = pick_one(batch.where(keyed), keys, [F.desc_nulls_last(order)]).unionByName(batch.where(~keyed))
    return target.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh, allowMissingColumns=True)


def evolve_schema(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Both frames' rows with all columns of either; what a frame lacks is null."""
    return target.unionByName(batch, allowMissingColumns=True)


def union_batches(frames: Sequence[DataFrame], stamp: Column | None = None) -> DataFrame:
    """Extracts one below the other by column name, under one ``dt_ingest`` if a stamp is given."""
    if not frames:
        raise ValueError("no extracts")
    out = reduce(evolve_schema, frames)
    return out if stamp is None else out.withColumn("dt_ingest", stamp)


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Put what is at ``new`` in place of what is at ``path``: the old one is renamed aside, the new one renamed, the old one
    deleted. A job that fails at any point leaves one of both whole, under ``path`` or beside it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    place, fresh, old = hadoop(path), hadoop(new), hadoop(f"{path}.{uuid.uuid4().hex}.old")
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    had = store.exists(place)
    if had and not store.rename(place, old):
        raise OSError(f"can't move {path} aside")
    if not store.rename(fresh, place):
        if had:
            store.rename(old, place)
        raise OSError(f"can't put the new data in place of {path}")
    if had:
        store.delete(old, True)


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace the dataset at ``path``: the new one is written aside and swapped in (see :func:`swap_in`)."""
    root = path.rstrip("/")
    new = f"{root}.{uuid.uuid4().hex}.new"
    df.write.parquet(new)
    swap_in(df.sparkSession, new, root)


def stamp(df: DataFrame, layer: str, has_ingest_date: bool = True, at: Column | None = None) -> DataFrame:
    """Audit columns of a layer, ``silver`` or ``gold``; without an ingest date that column is null."""
    if layer not in ("silver", "gold"):
        raise ValueError(f"unknown layer {layer!r}: silver or gold")
    out = df if has_ingest_date else df.withColumn("dt_ingest", F.lit(None).cast("timestamp"))
    return out.withColumn(f"dt_{layer}", F.current_timestamp() if at is None else at)


def table_names(files: DataFrame, path: str = "path", order: str = "processed_at", limit: int = NAME_LIMIT) -> DataFrame:
    """``table_name`` of each file: folders and stem in lower case joined by ``_``, cut to ``limit``, archive members
    (``zip::member``) under the archive's folder with the end of the member's stem kept; from the second file of a
    name on, ``_0001``, ``_0002`` by order."""
    clean = lambda c: F.regexp_replace(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", "_"), "^_+|_+$", "")
    squeeze = lambda c: F.regexp_replace(clean(c), "_+", "_")
    outer, inner = F.split_part(F.col(path), F.lit("::"), F.lit(1)), F.split_part(F.col(path), F.lit("::"), F.lit(2))
    stem = lambda c: F.regexp_replace(F.substring_index(c, "/", -1), r"(?<=.)\.[^.]*$", "")
    folders = F.filter(F.transform(F.split(outer, "/"), squeeze), lambda s: s != "")
    folder = F.array_join(F.slice(folders, 1, F.greatest(F.size(folders) - 1, F.lit(0))), "_")
    plain = F.left(F.concat_ws("_", F.nullif(folder, F.lit("")), squeeze(stem(outer))), F.lit(limit))
    member = F.concat_ws("_", F.nullif(folder, F.lit("")), squeeze(stem(inner)))
    room = F.lit(limit) - F.length(folder) - 1
    tail = F.right(squeeze(stem(inner)), F.greatest(room, F.lit(0)))
    after = F.regexp_replace(tail, "^[^_]*_", "")
    tail = F.when(tail.contains("_") & (after != ""), after).otherwise(F.ltrim(tail, F.lit("_")))
    packed = F.when(F.length(member) <= limit, member).when(room <= 0, F.left(folder, F.lit(limit))).otherwise(F.concat(folder, F.lit("_"), tail))
    named = files.withColumn("_base", F.when(inner != "", packed).otherwise(plain))
    n = F.row_number().over(Window.partitionBy("_base").orderBy(order, path)) - 1
    return named.withColumn("table_name", F.when(n == 0, F.col("_base")).otherwise(F.concat("_base", F.lit("_"), F.lpad(n.cast("string"), 4, "0")))).drop("_base")


def rename_plan(ledger: DataFrame, existing: DataFrame, path: str = "path", order: str = "processed_at") -> DataFrame:
    """What becomes of each ledger entry's ``table_name`` under today's naming: ``path``, ``table_name``, ``new_name``, ``outcome`` and
    ``step``. ``existing`` has the ``table_name`` of every table there is.

    ``kept`` entries have their name already; ``skipped`` ones have no table, so the ledger alone changes; the others are moves
    of a table, and a move is possible once its new name is free: it is nobody's, or its holder has moved on before. Moves
    form chains (every name has one holder and is wanted once), so those that end at a free name are ``renamed``, from
    their end on: ``step`` 0 first, then the one that waits for it. Chains that end at a table that stays, and cycles, are
    ``conflict``. The steps are found by doubling: each round a move learns where the chain stands twice as far on, so
    rounds grow with the logarithm of the longest chain. No join sends a side through the driver: names are few bytes on disk.
    """
    named = table_names(ledger.select(path, order, F.col("table_name").alias("_old")), path, order)
    plan = named.select(path, F.col("_old").alias("table_name"), F.col("table_name").alias("new_name"))
    held = existing.select(F.col("table_name").alias("_there")).distinct()
    told = plan.join(held.hint("merge"), F.col("table_name") == F.col("_there"), "left")
    first = F.row_number().over(Window.partitionBy("table_name").orderBy(path))  # two entries of one table: the first moves it
    same = F.col("table_name") == F.col("new_name")
    lost = F.col("_there").isNull() | (first > 1)
    told = stash(told.withColumn("outcome", F.when(same, "kept").when(lost, "skipped")).drop("_there"), "plan")

    moves = told.where("outcome is null").select(F.col("table_name").alias("name"), F.col("new_name").alias("next"))
    # a name that is held but not moved ends its chain badly: it stands for itself as its own next
    stays = held.select(F.col("_there").alias("name")).join(moves.select("name").hint("merge"), "name", "left_anti").select("name", F.col("name").alias("next"))
    hops = moves.unionByName(stays).select("name", "next", F.lit(1).cast("long").alias("hops"))
    n, far, ended = moves.count(), 1, 0
    while far <= n:  # a chain is at most as long as there are moves; what goes on longer is a cycle or a table that stays
        ahead = hops.select(F.col("name").alias("next"), F.col("next").alias("_next"), F.col("hops").alias("_hops"))
        met = hops.join(ahead.hint("merge"), "next", "left")
        walked = (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops")
        hops = stash(met.select("name", F.coalesce("_next", "next").alias("next"), walked, F.col("_next").isNull().alias("ended")), "hops")
        before, ended, far = ended, hops.where("ended").count(), 2 * far
        if ended == before:  # a chain that ends has all shorter ones in it: no more of this length, no more of any
            break
    # where the walk has come to a name without a holder, the chain is free
    ends = hops.join(hops.select(F.col("name").alias("next"), F.lit(True).alias("_held")).hint("merge"), "next", "left").where("_held is null")
    free = ends.select(F.col("name").alias("table_name"), (F.col("hops") - 1).alias("step"))
    found = told.join(free.hint("merge"), "table_name", "left")
    moved = F.when(F.col("step").isNotNull(), "renamed").otherwise("conflict")
    return found.select(path, "table_name", "new_name", F.coalesce("outcome", moved).alias("outcome"), F.when(F.col("outcome").isNull(), F.col("step")).alias("step"))


def half_year_windows(spark, start: str, end: str) -> DataFrame:
    """``begins`` and ``ends`` (exclusive) of the half years from January and July that meet ``[start, end)``, clipped."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    first = F.make_date(F.year(s), F.when(F.month(s) < 7, 1).otherwise(7), F.lit(1))
    months = F.explode(F.sequence(first, e, F.expr("interval 6 months"))).alias("b")
    return spark.range(1).select(months).select(F.greatest("b", s).alias("begins"), F.least(F.add_months("b", 6), e).alias("ends")).where("begins < ends")


def assign_half_year(df: DataFrame, at: str, start: str, end: str) -> DataFrame:
    """``window_begins`` of each row's half year, null outside ``[start, end)``; arithmetic, so no range join."""
    day, s = F.to_date(at), F.lit(start).cast("date")
    half = F.make_date(F.year(day), F.when(F.month(day) < 7, 1).otherwise(7), F.lit(1))
    return df.withColumn("window_begins", F.when((day >= s) & (day < F.lit(end).cast("date")), F.greatest(half, s)))


def surrogate_id(df: DataFrame, parent: str, children: Sequence[str], order: str, name: str = "record_id") -> DataFrame:
    """Key from the parent's, the position in the parent's list from 0, and the children's, null parts left out."""
    at = (F.row_number().over(Window.partitionBy(parent).orderBy(order)) - 1).cast("string")
    return df.withColumn(name, F.concat_ws("_", F.col(parent).cast("string"), at, *[F.col(c).cast("string") for c in children]))


@dataclass(frozen=True)
class LoadConfig:
    """How one target is loaded.

    Modes: ``upsert`` (new columns are added), ``refresh`` (the batch alone), ``drop_upsert`` (the batch alone, a row a key),
    ``append_dedupe`` (the first of equal rows stays) and, where no key is known, ``append``, which is refused. ``gate``
    keeps rows whose column starts with a prefix, ``batch_keep`` the first or last row of a key in the batch, ``fill`` gives
    key columns a default, ``explode`` names the list column of a parent record whose entries are the rows.
    """

    target: str
    keys: tuple[str, ...] = ()
    mode: str = "upsert"
    gate: tuple[str, str] | None = None
    batch_keep: str | None = None
    fill: tuple[tuple[str, str], ...] = ()
    explode: str | None = None


def prepare_batch(config: LoadConfig, batch: DataFrame, order: str = "dt_ingest") -> DataFrame:
    """The batch's rows as the target takes them: entries of a list, gated, a row of a key."""
    if config.explode:
        plain = [c for c in batch.columns if c != config.explode]
        batch = batch.select(*plain, F.explode(config.explode).alias("_child")).select(*plain, "_child.*")
    if config.gate:
        batch = batch.where(F.col(config.gate[0]).startswith(config.gate[1]))
    if config.batch_keep:
        batch = dedupe_batch(batch, config.keys, order, config.batch_keep, dict(config.fill))
    return batch


def apply_load(config: LoadConfig, target: DataFrame, batch: DataFrame, order: str = "dt_ingest") -> DataFrame:
    """The target after the batch, as frames; ``stored.load_into`` loads a target on disk. Plain appends are refused:
    repeating them would multiply rows."""
    batch = prepare_batch(config, batch, order)
    if config.mode == "upsert":
        return upsert(target, batch, config.keys, order)
    if config.mode == "refresh":
        return batch
    if config.mode == "drop_upsert":
        return upsert(target.limit(0), batch, config.keys, order)
    if config.mode == "append_dedupe":
        cols = list(config.keys) or [c for c in batch.columns if c != order]
        return dedupe_keep_first(evolve_schema(target, batch), cols, order)
    raise ValueError(f"{config.target}: append needs keys or a full refresh")


def _each(targets: str, keys: str, **more) -> list[LoadConfig]:
    return [LoadConfig(t, tuple(keys.split()), **more) for t in targets.split()]


#: The amounts, texts and days by which the treasury's commitment lines are told apart.
_COMMITMENT = "ne_ccor natureza_despesa doc_observacao ne_ccor_ano_emissao emissao_dia emissao_mes despesas_empenhadas despesas_liquidadas despesas_pagas"
_THIS_CENTURY = ("ne_ccor_ano_emissao", "20")

#: The targets of the data loads; names and keys are fixed values. Where ``append_dedupe`` names no columns, all of the file's
#: are compared.
LOADS: tuple[LoadConfig, ...] = tuple([
    *_each("ibge.agregados", "variavel_id localidade_id periodo classificacao_id categoria_id"),
    *_each("ibge.pnad_construcao", "periodo categoria_id"),
    *_each("bacen.financiamentos_imobiliarios", "tipo data"),
    *_each("bacen.credito_imobiliario_pib", "data"),
    *_each("fgv.incc_m fgv.icst", "mes"),
    *_each("fipe.indice_locacao abecip.poupanca_sbpe_mensal", "data_referencia"),
    *_each("infomoney.acoes_imob", "symbol data_pregao"),
    *_each("novo_caged.saldo_estoque_construcao_edificios", "ano mes"),
    *_each("mrv.lancamentos mrv.vendas", "periodo"),
    *_each("compras_gov.contratos compras_gov.contratos_inativos compras_gov.faturas compras_gov.terceirizados", "id"),
    *_each("compras_gov.empenhos", "id contrato_id"),
    *_each("compras_gov.cronograma", "id", mode="drop_upsert"),
    *_each("camara_deputados.deputados", "id siglapartido idlegislatura", batch_keep="first"),
    *_each("senado_federal.senadores", "id", batch_keep="first"),
    *_each("pncp.contratacoes", "numeroControlePNCP"),
    *_each("pncp.contratacoes_itens", "numeroItem numeroControlePNCP"),
    *_each("pncp.contratacoes_resultados", "numeroItem numeroControlePNCPCompra sequencialResultado situacaoCompraItemResultadoId"),
    *_each("siafi.nota_credito", "numero ano"),
    *_each("siafi.nota_empenho", "numEmpenho anoEmpenho"),
    *_each("siafi.programacao_financeira", "TRF__numeroDocumento"),
    *_each("siafi.empenhos_tesouro siafi.ne_tesouro_emendas siafi.ne_tesouro", _COMMITMENT, gate=_THIS_CENTURY),
    *_each("siafi.empenho_emendas_parlamentares", "ne_ccor emissao_dia emissao_mes programa_governo_numero programa_governo_nome ne_num_processo", gate=_THIS_CENTURY),
    *_each("siafi.nc_tesouro_pos__2026", "nc emissao_dia emissao_mes emissao_ano ptres ugr_codigo valor_celula dc"),
    *_each("siafi.nc_tesouro siafi.nc_tesouro_pre_2026 siafi.pf_tesouro siafi.programacao_acao_ptres", "", mode="append_dedupe"),
    *_each("siafi.visao_orcamentaria_total", "", mode="refresh"),
    *_each("siafi.orcamento_por_acao siafi.dotacao_execucao_outras_fontes", "", mode="append"),
    *_each("siape.lista_servidores", "cpf codUorg"),
    *_each("siape.lista_uorgs", "codigo"),
    *_each("siape.dados_pessoais siape.dados_financeiros siape.dados_funcionais siape.dados_escolares siape.dados_curriculo siape.dados_afastamento siape.dados_uorg siape.lista_aposentadoria", "cpf"),
    *_each("siape.dados_pa", "cpf_servidor"),
    *_each("siape.dados_dependentes", "cpf nome", explode="dependentes"),
    *_each("siape.pensoes_instituidas", "id_registro", explode="pensoes"),
    *_each("siape.dados_afastamento_historico", "", mode="append_dedupe", explode="afastamentos"),
    *_each("siorg.unidade_organizacional siorg.estrutura_organizacional_cargos", "codigoUnidade"),
    *_each("siorg.cargos_funcao", "codigoCargoFuncao"),
    *_each("transfere_gov.programas transfere_gov.programa_beneficiario", "id_programa"),
    *_each("transfere_gov.plano_acao", "id_plano_acao"),
    *_each("transfere_gov.notas_de_credito", "id_nota"),
    *_each("transfere_gov.programacao_financeira", "id_programacao"),
    *_each("transferegov_emendas.programas_especiais", "id_programa"),
    *_each("transferegov_emendas.planos_acao_especiais", "id_plano_acao"),
    *_each("transferegov_emendas.executor_especial", "id_plano_acao id_executor", batch_keep="last"),
    *_each("transferegov_emendas.finalidades_especiais", "id_executor cd_area_politica_publica_tipo_pt area_politica_publica_pt"),
    *_each("transferegov_emendas.metas_especiais", "id_meta"),
    *_each("transferegov_emendas.plano_trabalho_especial", "id_plano_trabalho"),
    *_each("transferegov_emendas.empenhos_especiais", "id_empenho"),
    *_each("transferegov_emendas.documentos_habeis_especiais", "id_dh"),
    *_each("transferegov_emendas.ordens_bancarias_especiais", "id_op_ob"),
    *_each("transferegov_emendas.historico_pagamentos_especiais", "id_historico_op_ob"),
    *_each("transferegov_emendas.relatorio_gestao_especial", "id_relatorio_gestao"),
    *_each("transferegov_emendas.relatorios_gestao_novo_especial", "id_relatorio_gestao_novo"),
    *_each("sgac.projetos_sgac", "id"),
])


def normal_name(name: str) -> str:
    """Lower case, runs of other than letters, digits and ``_`` to one ``_``, none at the ends."""
    return re.sub(r"_+", "_", re.sub(r"\W", "_", name.lower())).strip("_")


def normal_names(columns: Sequence[str]) -> list[tuple[int, str]]:
    """Position and normalised name of the columns that stay: repeated names get ``_1``, ``_2``; unnamed ones go."""
    kept, seen = [], {}
    for i, c in enumerate(columns):
        if re.fullmatch(r"unnamed[_:\s]*\d+", c.strip().lower()):
            continue
        base = normal_name(c)
        n = seen.get(base, -1) + 1
        seen[base] = n
        kept.append((i, f"{base}_{n}" if n else base))
    return kept


def normalize_columns(df: DataFrame) -> DataFrame:
    """Column names normalised; repeated names get ``_1``, ``_2``; unnamed columns go."""
    flat = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_{i}").alias(n) for i, n in normal_names(df.columns)])

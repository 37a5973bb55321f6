"""Queries and SQL of the operators on whole collections: spelling variants, the mix of sources, the Merkle manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marajo.llm import merkle, mix, variants

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: CTE ``crc``: the table of CRC-32 as the list ``t``; needs ``with recursive``.
CRC_TABLE = """
table_rows(n, k, c) as (
  select n, 0, n from range(0, 256) t(n)
  union all select n, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from table_rows where k < 8),
crc as (select list(c order by n) as t from table_rows where k = 8)"""


def crc_sql(text: str) -> str:
    """The unsigned CRC-32 of the UTF-8 bytes of ``text``, where ``t`` of the CTE ``crc`` is in reach."""
    code = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: cast('0x' || h as bigint))"
    return f"xor(list_reduce(list_prepend(4294967295, {code}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_forms(variants.vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet"), every=97))


OP11_SQL = rf"""
with recursive {CRC_TABLE},
runs as (
  select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), '{UPPER}', '{LOWER}') as run from documents where text is not null),
counted as (select doc_id, run, count(*) as n from runs where length(run) >= 5 group by all),
hashed as (select run, n, cast({crc_sql("coalesce(cast(doc_id as varchar), 'null') || ':' || run")} as bigint) as h from counted, crc),
slips as (
  select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from hashed),
vocab as (select word, cast(sum(n) as bigint) as n from slips where length(word) >= 5 group by word having sum(n) >= 3),
cuts as (
  select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, unnest(range(1, length(word) + 1)) as i from vocab)),
shorter as (select distinct c.word as a, v.word as b from cuts c join vocab v on v.word = c.rest),
near as (
  select a.word as a, b.word as b from cuts a join cuts b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select a, b from shorter union select b, a from shorter),
best as (select a as word, count(*) as n_near, first(v.word order by v.n desc, v.word) as top, max(v.n) as top_n from near join vocab v on v.word = b group by a),
formed as (
  select word, n, coalesce(n_near, 0) as n_near, case when top_n >= 2 * n then top end as form, case when top_n >= 2 * n then top_n end as form_n
  from vocab left join best using (word)),
walk(word, spot) as (select word, word from formed union all select w.word, f.form from walk w join formed f on f.word = w.spot where f.form is not null),
roots as (select w.word, w.spot as root from walk w join formed f on f.word = w.spot where f.form is null)
select word, form, root, n, n_near, form_n from formed join roots using (word)
"""


def op12_hypergeometric_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.per_document(mix.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), mix.Recipe()))


OP12_SQL = r"""
with d as (select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size from documents),
by_source as (select source, cast(sum(size) as bigint) as source_size from d group by source),
weights as (
  select source, source_size, 2 * source_size as cap, cast(list_extract([3, 1, 2], cast((row_number() over (order by source is null, source) - 1) % 3 + 1 as int)) as double) as weight
  from by_source),
rates as (
  select *, (1.5::double * (select sum(source_size) from weights)
    - coalesce(sum(cap) over (order by cap / weight, source rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by cap / weight, source rows between current row and unbounded following) as rate from weights),
targets as (
  select source, source_size, case when weight * rate > cap then cast(cap as double) else weight * rate end as target
  from weights, (select coalesce((select rate from rates where weight * rate <= cap order by cap / weight, source limit 1), 0) as rate)),
blocks as (
  select doc_id, source, block, least(512, size - 512 * block) as words, substr(md5('42|' || doc_id || '|' || block), 1, 16) as key
  from (select doc_id, source, size, unnest(range(0, (size - 1) // 512 + 1)) as block from d where size > 0)),
placed as (
  select *, coalesce(sum(words) over (partition by source order by key, doc_id, block rows between unbounded preceding and 1 preceding), 0) as before from blocks),
given as (
  select doc_id, sum(greatest(0, least(words, floor(target + 0.5) - before)) + greatest(0, least(words, floor(target + 0.5) - source_size - before))) as taken
  from placed join targets on placed.source is not distinct from targets.source group by doc_id)
select d.doc_id, d.size, source_size, target, cast(coalesce(taken, 0) as bigint) as taken
from d join targets on d.source is not distinct from targets.source left join given using (doc_id)
"""


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    leaf = lambda text: merkle.digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select(
        F.col("source").alias("owner"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(F.col("text")).alias("leaf"),
        F.when(tampered, leaf(F.translate("text", UPPER, LOWER))).alias("changed"),
    )
    return merkle.check(merkle.build(leaves))


def _op13_sql(levels: int = 6, top_levels: int = 4) -> str:
    """Level by level; 16 ** 6 documents of a source and 16 ** 4 sources at most."""
    part = lambda v: f"coalesce(strlen(cast({v} as varchar)) || ':' || {v}, '-')"
    leaf = lambda text: f"sha256({' || '.join(map(part, ('doc_id', 'source', 'lang', 'n_chars', text)))})"

    def climb(name: str, n: int) -> str:
        around = "string_agg(d, '') over (partition by owner, pos // 16 order by pos rows between {})"
        level = lambda k: f"""
{name}_near{k} as (select owner, pos, coalesce({around.format("unbounded preceding and 1 preceding")}, '') as before,
  coalesce({around.format("1 following and unbounded following")}, '') as after from {name}{k} where of > 1),
{name}{k + 1} as (select owner, pos // 16 as pos, (any_value(of) + 15) // 16 as of, sha256(string_agg(d, '' order by pos)) as d from {name}{k} where of > 1 group by owner, pos // 16)"""  # noqa: E731
        return ",".join(level(k) for k in range(n))

    def fold(name: str, tree: str, n: int) -> str:
        step = lambda k: f"""
{name}{k + 1} as (select f.* exclude (spot, folded, proof), f.spot // 16 as spot, coalesce(sha256(before || folded || after), folded) as folded, proof || coalesce(before || after, '') as proof
  from {name}{k} f left join {tree}_near{k} t on t.owner = f.owner and t.pos = f.spot)"""  # noqa: E731
        return ",".join(step(k) for k in range(n))

    return f"""
with recursive {CRC_TABLE},
leaves as (
  select coalesce('s' || source, 'n') as owner, doc_id, {leaf("text")} as leaf,
    case when {crc_sql("cast(doc_id as varchar)")} % 5 = 0 then {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} end as changed from documents, crc),
held as (select *, row_number() over (partition by owner order by doc_id) - 1 as pos, count(*) over (partition by owner) as of from leaves),
n0 as (select owner, pos, of, leaf as d from held),{climb("n", levels)},
subroots as ({" union all ".join(f"select owner, d from n{k} where of = 1" for k in range(levels + 1))}),
t0 as (select '' as owner, owner as source, row_number() over (order by owner) - 1 as pos, count(*) over () as of, d from subroots),{climb("t", top_levels)},
root as ({" union all ".join(f"select d as root from t{k} where of = 1" for k in range(top_levels + 1))}),
f0 as (select owner, doc_id, leaf, pos as spot, coalesce(changed, leaf) as folded, '' as proof from held),{fold("f", "n", levels)},
g0 as (select '' as owner, f.doc_id, f.leaf, t.d as subroot, t.pos as spot, f.folded, f.proof from f{levels} f join t0 t on t.source = f.owner),{fold("g", "t", top_levels)}
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded as folded_root, folded = root as verified from g{top_levels}, root
"""


QUERIES = {f.__name__: f for f in (op11_spelling_variants, op12_hypergeometric_mix, op13_merkle_manifest)}
SQL = {"op11_spelling_variants": OP11_SQL, "op12_hypergeometric_mix": OP12_SQL, "op13_merkle_manifest": _op13_sql()}

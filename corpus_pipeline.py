"""From raw documents to token ids: quality rules, line dedup, near-dedup, decontamination, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marajo.llm import decontam, jaccard, lines, pieces, quality
from marajo.llm.queries import piece_model
from marajo.session import discard_stashes, forget, stash, written_so_far


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with ``n_chars`` that of the text as it is now."""
    length = F.length("text").cast("long")
    return docs.select(*[length.alias(c) if c == "n_chars" else F.col(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff reject go; each row is judged by itself (see ``keep_good``)."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three-line windows that occurred before go; every document stays, a null text null, as ``dedup_lines`` has it."""
    return _recounted(lines.dedup_lines(docs), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a five-word Jaccard similarity of 0.8 or more, the one of the smallest id stays. Operator 1's index of
    fingerprints and MinHash bands for what it can't reach propose the links; each is verified."""
    return jaccard.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark go; others stay as they are, null texts too."""
    return _recounted(decontam.decontaminate(docs, _table(spark, sf_dir, "benchmark")), docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids under seeded merge-dropout, none for null and empty texts; every row gives one."""
    made = pieces.encode(docs, piece_model(spark))
    return made.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"), "ids", "lossless")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: SQL expresses neither the index of near copies nor the encoding; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents; each but the last is written to the shared folder, and what it was made of
    there is deleted then. The tables that the result still reads stay until ``session.discard_stashes``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        mark, before = written_so_far(), docs
        docs = stash(stage(spark, before, sf_dir), name)
        discard_stashes(spark, mark, keep=docs)
        forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Base measures decide plain failures. Beyond them each rule compares one ratio with a cutoff that is chosen from
labelled documents, separately per stratum (language). The labelled documents are halved by a hash of their id. One
half proposes: of each rule the cutoff that rejects the most bad documents, a rejected good one weighing as much as
``1 / risk`` bad ones, and the rules by what they so gain. The other half, the holdout, certifies: the rules are
added one by one in the proposed order, and a vector of cutoffs stands if the holdout shows, by an exact binomial
test, that it rejects at most ``risk`` of the stratum's good documents; testing stops at the first vector that fails
(a fixed sequence needs no correction within itself), and the level is divided by the number of strata tested. So
with probability ``1 - level`` no stratum loses more than ``risk`` of its good documents to all its rules together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marajo.session import small_side, stash

_SPACE = "[ \\t\\n\\x0B\\f\\r]+"
_SYMBOL = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rules:
    """Parameters: ``cutoffs`` go from the laxest on; a value above its cutoff rejects."""

    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    risk: float = 0.02
    level: float = 0.05
    cutoffs: dict[str, tuple[float, ...]] = field(
        default_factory=lambda: {
            "symbol_share": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01),
            "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
            "repeat_share": (0.28, 0.26, 0.24, 0.22, 0.2, 0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06),
            "word_length": (30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0),
        }
    )


def _bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated(hashes: Column, window: int) -> Column:
    """Words within windows whose hash stands at least twice in ``hashes``, the first occurrence included."""

    def count(ordered: Column) -> Column:
        n = F.size(ordered)
        again = lambda x, i: ((i > 0) & (F.get(ordered, i - 1)["h"] == x["h"])) | ((i < n - 1) & (F.get(ordered, i + 1)["h"] == x["h"]))
        at = F.sort_array(F.transform(F.filter(ordered, again), lambda x: x["i"]))
        start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(-window).alias("end"))
        step = lambda a, p: F.struct((a["words"] + p + window - F.greatest(a["end"], p)).alias("words"), (p + window).alias("end"))
        return F.aggregate(at, start, step, lambda a: a["words"])

    return _bind(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), count)


def measures(docs: DataFrame, rules: Rules = Rules(), carry: bool = False) -> DataFrame:
    """``doc_id``, ``stratum``, the base measures and ``base_failed`` of every row, with ``carry`` also the row itself as
    the struct ``row``; a null text has no words, an empty table gives no rows."""
    w = rules.window
    row = [F.struct(*docs.columns).alias("row")] if carry else []
    own = [F.col("row")] if carry else []
    split = docs.select(
        *row,
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("stratum") if "lang" in docs.columns else F.lit("").alias("stratum"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).select(
        *own,
        "doc_id",
        "stratum",
        "text",
        F.filter(F.split("text", _SPACE), lambda x: x != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]")).alias("lines"),
    )
    starts = F.sequence(F.lit(1), F.size("words") - (w - 1))
    hashed = F.transform(starts, lambda i: F.xxhash64(F.slice(F.col("words"), i, F.lit(w))))
    counted = split.select(
        *own,
        "doc_id",
        "stratum",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(_SYMBOL)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") >= w, hashed).alias("hashes"),
    )
    repeats = F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), _repeated(F.col("hashes"), w)).otherwise(0)
    told = counted.select(*[c for c in counted.columns if c != "hashes"], F.coalesce(repeats, F.lit(0)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    return told.withColumn("base_failed", failed)


def _values() -> dict[str, Column]:
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "word_length": share("word_chars", "n_words"),
    }


def lower_tail(n: Column, k: Column, p: float) -> Column:
    """Exact P(X <= k) of a binomial with ``n`` trials of chance ``p``, summed in logarithms; 1 for k > n p."""
    odds = math.log(p) - math.log1p(-p)
    first = n * math.log1p(-p)
    start = F.struct(first.alias("term"), first.alias("sum"))

    def step(a: Column, i: Column) -> Column:
        term = a["term"] + F.ln((n - i + 1) / i) + odds
        high, low = F.greatest(term, a["sum"]), F.least(term, a["sum"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    upto = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.exp(F.aggregate(upto, start, step, lambda a: a["sum"])))


def _need(m: Column, rules: Rules) -> Column:
    """Good holdout documents without which nothing can be certified at an ``m``-th of the level, even with no rejection among them."""
    return F.ceil(F.ln(F.lit(rules.level) / m) / math.log1p(-rules.risk))


def strata(labelled: DataFrame, rules: Rules) -> DataFrame:
    """``stratum`` and the ``tested`` stratum that its documents are judged in (null: in none): its own, or, for all that have too few
    labels to be certified alone, one together.

    How many strata are tested decides how many labels each needs, and that decides how many are tested: it is the smallest
    number that fits. Only numbers of labels are looked at, which say nothing about rejections, so the level holds.
    """
    sizes = stash(labelled.groupBy("stratum").agg(F.count_if(F.col("good") & ~F.col("proposes")).alias("n")), "strata")
    rest = lambda m: F.aggregate(F.filter("ns", lambda n: n < _need(m, rules)), F.lit(0).cast("long"), lambda a, n: a + n)
    alone = lambda m: F.size(F.filter("ns", lambda n: n >= _need(m, rules)))
    together = lambda m: rest(m) >= _need(m, rules)
    fits = F.filter(F.sequence(F.lit(1), F.greatest(F.size("ns"), F.lit(1))), lambda m: alone(m) + together(m).cast("int") <= m)
    m = sizes.agg(F.collect_list("n").alias("ns")).withColumn("m", F.array_min(fits))
    one = m.select(_need(F.col("m"), rules).alias("need"), together(F.col("m")).alias("together"))
    own = F.when(F.col("n") >= F.col("need"), F.concat(F.lit("="), "stratum")).when(F.col("together"), F.lit("*"))
    return sizes.crossJoin(F.broadcast(one)).select("stratum", own.alias("tested"))


def thresholds(found: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``stratum`` and ``limits`` (map from rule to cutoff) certified on the labelled documents of ``found``. Strata with few labels
    are certified together, if at all (see :func:`strata`): for them, the risk holds over their documents taken together.

    Rows of null quality or id don't count, base failures neither (they are gone already); a document id with several
    labels has its worst. Ties between cutoffs go to the laxest, between rules to the first by name.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality")
    )
    values = F.map_from_arrays(F.array(*map(F.lit, _values())), F.array(*_values().values()))
    labelled = found.where(~F.col("base_failed")).join(known, "doc_id").select(
        "stratum", (F.col("quality") >= 1).alias("good"), values.alias("values"), (F.md5(F.col("doc_id").cast("string")) < "8").alias("proposes")
    )
    labelled = stash(labelled, "labelled")
    members = small_side(strata(labelled, rules).withColumnRenamed("stratum", "member"), "strata")
    labelled = labelled.join(members, F.col("stratum") == F.col("member")).where(F.col("tested").isNotNull()).drop("stratum", "member").withColumnRenamed("tested", "stratum")
    cuts = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(float(c)).alias("cutoff"), F.lit(i).alias("at")) for r, own in rules.cutoffs.items() for i, c in enumerate(own)])
    counts = (
        labelled.where("proposes")
        .select("stratum", "good", "values", F.explode(cuts).alias("t"))
        .where(F.col("values")[F.col("t.rule")] > F.col("t.cutoff"))
        .groupBy("stratum", "t.rule", "t.cutoff", "t.at")
        .agg((F.count_if(~F.col("good")) - F.count_if("good") * (1 / rules.risk)).alias("gain"))
        .where("gain > 0")
    )
    best = counts.groupBy("stratum", "rule").agg(F.max(F.struct("gain", (-F.col("at")).alias("lax"), "cutoff")).alias("m"))
    # the vector in order of testing
    order = F.sort_array(F.collect_list(F.struct((-F.col("m.gain")).alias("loss"), "rule", F.col("m.cutoff").alias("cutoff"))))
    vectors = small_side(best.groupBy(F.col("stratum").alias("own")).agg(order.alias("vector")), "vectors")
    n_strata = max(vectors.count(), 1)
    hit = F.array_min(F.filter(F.transform("vector", lambda v, i: F.when(F.col("values")[v["rule"]] > v["cutoff"], i + 1)), lambda i: i.isNotNull()))
    held = labelled.where(~F.col("proposes") & F.col("good")).join(vectors, F.col("stratum") == F.col("own"))
    tested = (
        held.select("own", "vector", hit.alias("hit"), F.explode(F.sequence(F.lit(1), F.size("vector"))).alias("upto"))
        .groupBy("own", "upto")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("hit") <= F.col("upto")).alias("k"), F.first("vector").alias("vector"))
        .withColumn("passed", lower_tail(F.col("n"), F.col("k"), rules.risk) <= rules.level / n_strata)
    )
    failed = F.min(F.when(~F.col("passed"), F.col("upto")))
    certified = tested.groupBy("own").agg(F.coalesce(failed - 1, F.max("upto")).alias("upto"), F.first("vector").alias("vector")).where("upto > 0")
    chosen = F.transform(F.slice("vector", F.lit(1), F.col("upto")), lambda v: F.struct(v["rule"], v["cutoff"]))
    limits = certified.select("own", F.map_from_entries(chosen).alias("limits"))
    return members.join(limits, F.col("tested") == F.col("own")).select(F.col("member").alias("stratum"), "limits")


def _verdict(found: DataFrame, labels: DataFrame, rules: Rules) -> DataFrame:
    """``found`` with ``kept``: no base failure, and no value beyond a certified cutoff of the row's stratum."""
    limits = small_side(thresholds(found, labels, rules).withColumnRenamed("stratum", "limit_stratum"), "limits")
    over = F.lit(False)
    for rule, value in _values().items():
        over = over | F.coalesce(value > F.try_element_at("limits", F.lit(rule)), F.lit(False))
    return found.join(limits, F.col("stratum") == F.col("limit_stratum"), "left").withColumn("kept", ~F.col("base_failed") & ~over).drop("limit_stratum")


def judge(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Measures and verdict (``kept``) of every row of ``docs``.

    Null, empty and blank texts have no words and fail the base rule. Rows without a language form a stratum of
    their own. Without labels, or with too few good ones to certify anything, only the base rules reject. Rows without
    an id are judged by the cutoffs of their stratum. Repeated rows each get their verdict; other columns are not
    read; an empty table gives no rows. The measures are written once to the shared folder, as both the calibration
    and the verdict read them.
    """
    return _verdict(stash(measures(docs, rules), "measures"), labels, rules)


def keep_good(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were.

    Every row is judged by itself, as :func:`judge` does, rows without an id and repeated ones too. Rows are written
    once with their measures, so the verdict filters them where they lie.
    """
    kept = _verdict(stash(measures(docs, rules, carry=True), "measured"), labels, rules).where("kept")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])

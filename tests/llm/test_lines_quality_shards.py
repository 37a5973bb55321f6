import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from marajo.llm import lines, quality, shards

from .common import AWKWARD, docs


def plain_lines(rows):
    """Later occurrences of three-line windows by walking all texts in order."""
    seen, gone = set(), {}
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, str(r[1])))
    for i, t in order:
        ls = t.split("\n") if t is not None else []
        for p in range(len(ls) - 2):
            w = tuple(ls[p : p + 3])
            if w in seen:
                gone.setdefault((i, t), set()).update(range(p, p + 3))
            seen.add(w)
    return [(i, None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone.get((i, t), ())), len(gone.get((i, t), ()))) for i, t in rows]


def test_line_dedup_equals_a_walk(spark):
    given = docs(spark)
    out = lines.dedup_lines(given)
    assert set(out.columns) == set(given.columns)  # n_lines and n_removed are replaced
    assert sorted(map(str, ((r.doc_id, r.text, r.n_removed) for r in out.collect()))) == sorted(map(str, plain_lines(AWKWARD)))
    assert lines.dedup_lines(docs(spark, [])).collect() == []


def test_a_line_four_times_keeps_one(spark):
    out = lines.dedup_lines(docs(spark, [(1, "x\nx\nx\nx"), (2, "only\ntwo")])).collect()
    assert {r.doc_id: r.text for r in out} == {1: "x", 2: "only\ntwo"}


def test_measures_on_awkward_rows(spark):
    found = {(r.doc_id, r.n_words): r for r in quality.measures(docs(spark)).collect()}
    long = found[5, 20_000]
    assert not found[1, 21].base_failed and found[7, 1].base_failed and long.n_words == 20_000
    repeated = quality.measures(docs(spark, [(1, "a b c d e f g h " * 3 + "tail"), (2, "k " * 9)])).collect()
    assert {r.doc_id: (r.n_repeat_words, r.base_failed) for r in repeated} == {1: (24, True), 2: (9, True)}


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.1), (500, 3, 0.02), (20_000, 10, 0.001), (50, 40, 0.1)])
def test_exact_binomial_tail(spark, n, k, p):
    got = spark.createDataFrame([(n, k)], "n long, k long").select(quality.lower_tail(F.col("n"), F.col("k"), p)).first()[0]
    exact = 1.0 if k > n * p else sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
    assert got == pytest.approx(exact, rel=1e-9)


LANGS = ("en", "de", "fr", None)


def labelled_rows():
    """English and German documents with junk of two kinds, French ones too few to certify, and rows without a language."""
    rows = []
    for lang, n in zip(LANGS, (1500, 900, 150, 20)):
        for i in range(n):
            words = [f"word{j}" for j in range(40)] + [f"v{lang}{i}"]
            good = i % 6 != 0
            if not good:
                words += [f"###{j}$&*" for j in range(60)] if i % 12 else [f"{'long' * 12}{j}" for j in range(40)]
            elif i % 400 == 1:  # rare good ones that a rule hits
                words += [f"#{j}" for j in range(8)]
            rows.append((len(rows), " ".join(words), lang, int(good)))
    return rows


def plain_strata(n, rules):
    """The stratum that each language is judged in: the fewest strata that leave each enough holdout documents."""
    for m in range(1, len(n) + 1):
        need = math.ceil(math.log(rules.level / m) / math.log1p(-rules.risk))
        rest = sum(k for k in n.values() if k < need)
        if sum(k >= need for k in n.values()) + (rest >= need) <= m:
            return {s: s if k >= need else "*" if rest >= need else None for s, k in n.items()}


def plain_limits(rows, rules):
    """Certified cutoffs by language, by the same procedure over lists."""
    from collections import defaultdict

    by, strata = defaultdict(list), defaultdict(list)
    for i, t, lang, good in rows:
        w = t.split()
        chars = sum(map(len, w))
        v = {"symbol_share": sum(c in "#*$%&|<>" for c in t) / chars, "dup_line_share": 0.0, "repeat_share": 0.0, "word_length": chars / len(w)}
        by[lang or ""].append((v, good, hashlib.md5(str(i).encode()).hexdigest() < "8"))
    tested = plain_strata({s: sum(g and not p for _, g, p in own) for s, own in by.items()}, rules)
    for s, own in by.items():
        strata[tested[s]] += own
    strata.pop(None, None)
    vectors = {}
    for s, own in strata.items():
        picks = []
        for rule, cuts in rules.cutoffs.items():
            gains = [(sum((1 - g) - g / rules.risk for v, g, p in own if p and v[rule] > c), -k, c) for k, c in enumerate(cuts)]
            if max(gains)[0] > 0:
                picks.append((-max(gains)[0], rule, max(gains)[2]))
        if picks:
            vectors[s] = sorted(picks)
    out = {}
    for s, vector in vectors.items():
        good = [v for v, g, p in strata[s] if g and not p]
        for upto in range(1, len(vector) + 1):
            k, n, r = sum(any(v[rule] > c for _, rule, c in vector[:upto]) for v in good), len(good), rules.risk
            if k > n * r or sum(math.comb(n, i) * r**i * (1 - r) ** (n - i) for i in range(k + 1)) > rules.level / len(vectors):
                break
            out[s] = {rule: c for _, rule, c in vector[:upto]}
    return {s: out[t] for s, t in tested.items() if t in out}


def test_thresholds_are_certified_on_the_holdout_and_reject_bad(spark):
    rows, rules = labelled_rows(), quality.Rules()
    labels = spark.createDataFrame([(i, g, 0) for i, _, _, g in rows] + [(None, 0, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame([(i, t, lang) for i, t, lang, _ in rows], "doc_id long, text string, lang string")
    want = plain_limits(rows, rules)
    assert set(want) == {"en", "de"} and any(len(x) == 2 for x in want.values())
    got = {r.stratum: dict(r.limits) for r in quality.thresholds(quality.measures(frame), labels, rules).collect()}
    assert got == want
    verdict = {r.doc_id: r.kept for r in quality.judge(frame, labels).collect()}
    for s in ("en", "de"):
        bad = [verdict[i] for i, _, lang, g in rows if lang == s and not g]
        good = [verdict[i] for i, _, lang, g in rows if lang == s and g]
        assert sum(good) >= (1 - rules.risk) * len(good) and sum(bad) <= 0.1 * len(bad)
    assert all(verdict[i] for i, _, lang, _ in rows if lang not in ("en", "de"))  # too few labels certify nothing
    assert all(r.kept for r in quality.judge(frame, labels.limit(0)).collect())


def test_languages_with_few_labels_are_certified_together(spark):
    rules = quality.Rules()
    rows = [(i, t, "abcde"[i % 5], g) for i, t, _, g in labelled_rows()[:700]]
    labels = spark.createDataFrame([(i, g, 0) for i, _, _, g in rows], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame([(i, t, lang) for i, t, lang, _ in rows] + [(9999, rows[0][1], "unlabelled")], "doc_id long, text string, lang string")
    want = plain_limits(rows, rules)
    assert set(want) == set("abcde") and len({str(x) for x in want.values()}) == 1
    assert {r.stratum: dict(r.limits) for r in quality.thresholds(quality.measures(frame), labels, rules).collect()} == want
    verdict = {r.doc_id: r.kept for r in quality.judge(frame, labels).collect()}
    assert sum(verdict[i] for i, _, _, g in rows if not g) <= 60 and verdict[9999]
    for n in ({"a": 150}, {"a": 149, "b": 148}, {"a": 500, "b": 10}, {"a": 500, "b": 500, "c": 170, "d": 100, "e": 3}, {"a": 0}, {"a": 100, "b": 40}):
        flat = spark.createDataFrame([(s, True, False) for s, k in n.items() for _ in range(k)] + [(s, False, True) for s in n], "stratum string, good boolean, proposes boolean")
        own = {s: t and (t if t == "*" else f"={t}") for s, t in plain_strata(n, rules).items()}
        assert {r.stratum: r.tested for r in quality.strata(flat, rules).collect()} == own


def test_keep_good_leaves_columns_and_judges_each_row(spark):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    enough = AWKWARD[0][1]
    given = docs(spark, [*AWKWARD, (None, enough), (9, enough)])
    kept = quality.keep_good(given, labels)
    assert kept.columns == given.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, -5, 5, 6, None, 9]))
    assert quality.keep_good(docs(spark, []), labels).collect() == [] and quality.judge(docs(spark, []), labels).collect() == []


def test_places_are_gapless_and_hold_the_text(spark):
    rows = shards.place(docs(spark), shards.even_tree(40), shards.even_tree(41)).collect()
    assert len(rows) == len(AWKWARD)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in AWKWARD)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 40)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert shards.place(docs(spark, []), shards.even_tree(40)).collect() == []


def plain_place(doc_id, leaves):
    """Descent level by level: a node's draw is the smallest of its children's."""
    draw = {}
    for x in leaves:
        u = (int(hashlib.md5(f"{doc_id}|{x.path}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        draw[x] = -math.log(u) / x.weight
    region = min({x.region for x in leaves}, key=lambda r: min(draw[x] for x in leaves if x.region == r))
    rack = min({x.rack for x in leaves if x.region == region}, key=lambda k: min(draw[x] for x in leaves if (x.region, x.rack) == (region, k)))
    return min((x for x in leaves if (x.region, x.rack) == (region, rack)), key=draw.__getitem__).shard


def test_weights_steer_and_movement_stays_in_the_changed_subtree(spark):
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    old = [shards.Leaf(s % 2, 0, s, 1.0) for s in range(4)]
    new = [shards.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 2 else 1.0) for x in old]
    rows = shards.place(frame, old, new).collect()
    assert [r.shard for r in sorted(rows)] == [plain_place(i, old) for i in range(3000)]
    assert [r.grown_shard for r in sorted(rows)] == [plain_place(i, new) for i in range(3000)]
    assert all(r.grown_shard in (r.shard, 2) for r in rows)
    assert 0.45 < sum(r.grown_shard == 2 for r in rows) / 3000 < 0.55


def test_drained_shards_and_hashed_repeated_and_null_ids(spark):
    leaves = [shards.Leaf(s % 2, s % 3, s, 0.0 if s == 1 else 2.0) for s in range(5)]
    ids = [hash((i, 7)) for i in range(400)] + [11] * 300 + [None] * 300
    frame = docs(spark, [(i, f"t{k % 5}") for k, i in enumerate(ids)])
    rows = shards.place(frame, leaves, [x for x in leaves if x.shard != 4]).collect()
    assert len(rows) == 1000 and {r.shard for r in rows} == {0, 2, 3, 4} and {r.grown_shard for r in rows} == {0, 2, 3}
    assert all(r.shard == r.grown_shard for r in rows if r.shard != 4)
    for shard in {r.shard for r in rows}:
        own = sorted((r for r in rows if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        order = [(r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size) for r in own]
        assert order == sorted(order)
    one = [shards.Leaf(0, 0, 0, 0.0)]
    rows = shards.place(frame, one).collect()
    assert {r.shard for r in rows} == {None} and sorted(r.slot for r in rows) == list(range(1000))
    with pytest.raises(ValueError):
        shards.place(frame, [shards.Leaf(0, 0, 0, -1.0)])

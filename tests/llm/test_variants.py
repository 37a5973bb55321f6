import random
import re
import zlib
from collections import Counter
from itertools import combinations

from marajo.llm import variants

from .common import AWKWARD, LONG, docs


def near(a, b):
    """One inserted, deleted or replaced code point, by trying all."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_vocabulary(rows, every, least=3):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= least}


def plain_forms(vocab):
    by = {w: [v for v in vocab if near(w, v)] for w in vocab}
    top = {w: min(vs, key=lambda v: (-vocab[v], v)) for w, vs in by.items() if vs}
    form = {w: v for w, v in top.items() if vocab[v] >= 2 * vocab[w]}
    out = set()
    for w in vocab:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, vocab[w], len(by[w]), vocab.get(form.get(w))))
    return out


def grown_vocabulary(seed):
    """Words of few letters and chains of variants, so that lists are long and roots far."""
    draw = random.Random(seed)
    words = {"".join(draw.choice("abà÷é") for _ in range(draw.randint(5, 9))) for _ in range(150)}
    for w in sorted(words)[:40]:
        for _ in range(4):
            at = draw.randrange(len(w))
            w = draw.choice([w[:at] + w[at + 1 :], w[:at] + "x" + w[at:], w[:at] + "y" + w[at + 1 :]])
            words.add(w)
    words |= {"aaaaaa", "aaaaaaa", "aaaaaab", "baaaaaa", "ababab", "bababa", "abababa"}
    return {w: draw.choice([1, 1, 2, 5, 5, 11, 40, 200]) for w in sorted(words) if len(w) >= 5}


def test_vocabulary_counts_slips_and_awkward_rows(spark):
    rows = [*AWKWARD, (77, "Maison MAISON maïson×deux École école ÉCOLE " * 200), (78, "mai-son it's 3maison9 abcd"), (None, "Maison " * 5), (77, "Maison " * 5)]
    for every in (None, 1, 3):
        got = variants.vocabulary(docs(spark, rows), every).collect()
        assert {r.word: r.n for r in got} == plain_vocabulary(rows, every)
    assert variants.vocabulary(docs(spark, [])).collect() == []
    assert variants.vocabulary(docs(spark, [(1, LONG), (2, None)])).collect() == []


def test_forms_equal_all_pairs(spark):
    for seed in range(3):
        vocab = grown_vocabulary(seed)
        frame = spark.createDataFrame(list(vocab.items()), "word string, n long")
        assert {tuple(r) for r in variants.spelling_forms(frame).collect()} == plain_forms(vocab)
    empty = spark.createDataFrame([], "word string, n long")
    assert variants.spelling_forms(empty).collect() == []
    assert {tuple(r) for r in variants.spelling_forms(frame.limit(0).union(spark.createDataFrame([("alone", 3)], frame.schema))).collect()} == {("alone", None, "alone", 3, 0, None)}


def test_no_table_of_words_is_broadcast(spark):
    key, vocab = "spark.sql.maxBroadcastTableSize", grown_vocabulary(7)
    before = spark.conf.get(key)
    frame = spark.createDataFrame(list(vocab.items()), "word string, n long")
    spark.conf.set(key, "1b")  # a broadcast fails
    try:
        assert {tuple(r) for r in variants.spelling_forms(frame).collect()} == plain_forms(vocab)
    finally:
        spark.conf.set(key, before)


def test_a_bigram_that_all_words_share(spark):
    words = ["zz" + "".join(x) for x in combinations("abcdefghij", 4)] + [None, "zzab", "zzabc", "zzabcd"]
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    kept = {w for w in words if w and len(w) >= 5}
    assert {(r.a, r.b) for r in variants.near_words(frame).collect()} == {(a, b) for a in kept for b in kept if near(a, b)}


def test_pivots_are_the_cheapest_disjoint_pair():
    draw = random.Random(5)
    for _ in range(300):
        places = sorted(draw.sample(range(12), draw.randint(3, 6)))
        costs = {p: draw.randint(1, 4) for p in places}
        pairs = [(a, b) for a, b in combinations(places, 2) if b - a >= 2]
        a, b = variants.disjoint_pair(sorted(costs.items()))
        assert b - a >= 2 and costs[a] + costs[b] == min(costs[x] + costs[y] for x, y in pairs)

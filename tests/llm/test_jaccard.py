import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marajo.llm import jaccard, shared, simhash

from .common import docs

SF = "/root/testdata/sf0.001"


def grams(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows, percent=80):
    """Ids that stay when all pairs are compared."""
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    low = {}
    for x, (i, _) in enumerate(rows):
        low[find(x)] = min(low.get(find(x), i), i)
    return sorted(i for x, (i, _) in enumerate(rows) if i == low[find(x)])


def test_the_stage_equals_comparing_all_pairs(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 20000")
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, given, SF)
    assert kept.columns == given.columns
    assert sorted(r.doc_id for r in kept.collect()) == plain_kept([(r.doc_id, r.text) for r in given.collect()])


def test_common_counts_every_pair():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 300, r.integers(0, 90))) for _ in range(40)] + [np.arange(50)] * 20
    sizes = np.array([len(s) for s in sets])
    want = [[len(np.intersect1d(x, y)) for y in sets] for x in sets]
    assert jaccard.common(np.concatenate(sets), sizes).tolist() == want


@pytest.mark.parametrize("part", [1 << 15, 400])
def test_near_copies_beyond_two_bits_go(spark, monkeypatch, part):
    monkeypatch.setattr(jaccard, "PART", part)  # lists in one part, or in many
    r = random.Random(7)
    base = [f"w{r.randrange(10**6)}" for _ in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 40):  # three to five changed words: similarity of 0.84 to 0.9 to the first
        words = list(base)
        for at in r.sample(range(10, 290), 3 + i % 3):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(base[: 60 * i] + [f"z{i}q{j}" for j in range(300 - 60 * i)])) for i in range(1, 5)]
    # a chain around the threshold, which the heads of a list don't tie together
    far = [f"v{r.randrange(10**6)}" for _ in range(200)]
    rows += [(200 + i, " ".join(f"u{i}p{j}" if i <= j // 3 < i + 4 else w for j, w in enumerate(far))) for i in range(30)]
    kept = sorted(x.doc_id for x in jaccard.keep_first(docs(spark, rows)).collect())
    assert kept == plain_kept(rows) and 39 not in kept and {0, 101, 102, 103, 104} <= set(kept)


def test_small_sets_link_from_four_shingles_on(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART_SETS", 3)
    words = [f"w{i}" for i in range(40)]
    rows = [(10 * n + k, " ".join(words[k : k + n])) for n in range(1, 12) for k in range(3)]
    rows += [(500 + i, "the very same five words " + f"end{i}") for i in range(60)]
    kept = sorted(x.doc_id for x in jaccard.keep_first(docs(spark, rows)).collect())
    assert kept == plain_kept(rows) and len(kept) < len(rows)


def test_idless_wordless_and_repeated_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (4, "A\tb"), (None, "a b"), (5, "a b c")]
    kept = jaccard.keep_first(docs(spark, rows))
    assert sorted(str(x.doc_id) for x in kept.collect()) == ["1", "3", "3", "5", "None"]
    assert jaccard.keep_first(docs(spark, [])).collect() == []


def test_many_ids_move_no_text(spark, monkeypatch):
    base = [" ".join(f"w{i}x{k}" for i in range(40)) for k in range(12)]
    rows = [(k, t) for k, t in enumerate(base)] + [(100 + k, t + " tail") for k, t in enumerate(base)] + [(None, base[0]), (200, None), (201, ""), (3, base[5])]
    given = docs(spark, rows)
    want = sorted(map(str, jaccard.keep_first(given).collect()))
    monkeypatch.setattr(jaccard, "FEW_IDS", -1)
    out = jaccard.keep_first(given)
    assert sorted(map(str, out.collect())) == want and len(want) < len(rows)
    monkeypatch.setattr(shared, "SET_BITS", 64)  # most ids that stay are looked up as well
    assert sorted(map(str, jaccard.keep_first(given).collect())) == want
    ids = spark.range(50, 60).withColumnRenamed("id", "doc_id")
    inside = {r.doc_id for r in shared.possibly_in(given, "doc_id", ids).collect()}
    outside = {r.doc_id for r in shared.possibly_in(given, "doc_id", ids, negate=True).collect()}
    assert not inside & outside and inside | outside == {i for i, _ in rows}


def test_the_index_of_fingerprints_gives_verified_links(spark):
    r = random.Random(11)
    base = [f"w{r.randrange(10**6)}" for _ in range(400)]
    told = lambda t: simhash.majority(jaccard.shingles(t.encode()))
    near = next(t for t in (" ".join([*base, f"end{i}"]) for i in range(100)) if 0 < (told(t) ^ told(" ".join(base))).bit_count() <= 2)
    given = docs(spark, [(1, " ".join(base)), (2, near), (3, " ".join(f"a{i}" for i in range(50))), (4, " ".join(f"b{i}" for i in range(50)))])
    made = jaccard.sketches(given)
    node = {x.doc_id: x.node for x in made.collect()}
    # no band posts anything; the last two texts get one fingerprint, though they share no shingle
    first = made.withColumnRenamed("doc_id", "first_id").withColumn("bands", F.array().cast("array<long>"))
    first = first.withColumn("fp", F.when(F.col("first_id") > 2, F.lit(5)).otherwise(F.col("fp"))).localCheckpoint()
    found = {frozenset(x) for x in jaccard.links(given, first).collect()}
    assert found == {frozenset((node[1], node[2]))}


def test_the_stage_takes_the_fingerprints_of_its_sets(spark):
    given = docs(spark)
    for x in jaccard.sketches(given).join(given.select("doc_id", "text").distinct(), "doc_id").collect():
        held = jaccard.shingles((x.text or "").encode()).tolist()
        assert x.fp % (1 << 64) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in held) > len(held))

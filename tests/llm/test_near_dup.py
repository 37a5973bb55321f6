import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from marajo.llm import graph, simhash

from .common import AWKWARD, docs


def plain_fingerprint(text, n=3):
    """By the definition, bit by bit."""
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(pairs):
    """Smallest reachable id of each (id, fingerprint) by comparing all pairs."""
    ids = [i for i, _ in pairs]
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(pairs)):
        for b in range(a):
            if (pairs[a][1] ^ pairs[b][1]).bit_count() <= 2:
                parent[find(a)] = find(b)
    groups = {}
    for x, i in enumerate(ids):
        groups.setdefault(find(x), []).append(i)
    return [min((i for i in groups[find(x)] if i is not None), default=None) for x in range(len(ids))]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB c\t\nÉ\x0b", max_size=60))
def test_fingerprint_follows_its_definition(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_awkward_rows(spark):
    rows = simhash.near_duplicates(docs(spark)).collect()
    expected = [(i, plain_fingerprint(t or "")) for i, t in AWKWARD]
    want = sorted((str(i), f"{fp:016x}", str(c)) for (i, fp), c in zip(expected, components(expected)))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want
    assert simhash.near_duplicates(docs(spark, [])).collect() == []


def test_any_pair_within_two_bits_meets_in_a_list():
    r = random.Random(3)
    masks = simhash._list_masks(2)
    for _ in range(3000):
        a = r.getrandbits(64)
        b = a ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64))
        assert any(a & m == b & m for m in masks)


def test_long_lists_leave_the_same_components(spark):
    r = random.Random(5)
    seeds = [r.getrandbits(64) for _ in range(4)]
    fps = {s ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(16)) for s in seeds for _ in range(60)}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")

    def labels(limit):
        edges = simhash.links(frame, 2, limit)
        return {r.node: r.label for r in graph.connected_components(edges).collect()}

    short, long = labels(10_000), labels(3)
    assert short == long
    brute = components([(f, int(np.int64(f).view(np.uint64))) for f in signed])
    assert {f: short.get(f, f) for f in signed} == dict(zip(signed, brute))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    found = {r.node: r.label for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}


def test_one_of_each_group_stays(spark):
    given_ = docs(spark)
    kept = simhash.keep_first(given_)
    assert kept.columns == given_.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == sorted([(True, i) for i in (-5, 2, 5, 7, 7, 8, 9, 10)] + [(False, 0)] * 2)

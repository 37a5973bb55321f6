import hashlib
import math
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from marajo.llm import mix

from .common import AWKWARD, docs


def plain_targets(sizes, recipe):
    """Sharing out again and again, in whole fractions."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: Fraction(recipe.weights[i % len(recipe.weights)]) for i, s in enumerate(order)}
    left, free, got = Fraction(recipe.share) * sum(sizes.values()), set(order), {}
    while free:
        rate = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * rate > recipe.most * sizes[s]}
        if not over:
            return got | {s: weight[s] * rate for s in free}
        got |= {s: Fraction(recipe.most * sizes[s]) for s in over}
        left -= sum(got[s] for s in over)
        free -= over
    return got


def corpus(spark):
    rows = [(i, "w " * (7 * i % 90 + (3000 if i == 50 else 0)), "abcdé"[min(4, i % 9)]) for i in range(400)]
    rows += [(i, "w " * 11, None) for i in range(400, 420)] + [(500 + k, t, "odd") for k, (_, t) in enumerate(AWKWARD)]
    rows += [(900, None, "void"), (901, "", "void"), (None, "a b c", "odd"), (None, "a b c", "odd"), (7, "a b c", "odd")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("?") for c in ("size", "row", "key", "pos", "shard", "place", "at", "task")})


def test_sources_meet_their_targets_to_the_word(spark):
    rows, frame = corpus(spark)
    recipe = mix.Recipe(words=16, shards=7)
    made = mix.mix(frame, recipe)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    want = plain_targets(sizes, recipe)
    got = {r.source: r for r in made.targets.collect()}
    assert {s: r.source_size for s, r in got.items()} == sizes
    assert {s: r.target for s, r in got.items()} == pytest.approx({s: float(t) for s, t in want.items()})
    assert any(t == 2 * sizes[s] for s, t in want.items() if sizes[s]) and want["void"] == 0
    docs_ = mix.per_document(made).collect()
    assert sorted((str(r.doc_id), r["size"]) for r in docs_) == sorted((str(i), size(t)) for i, t, _ in rows)
    assert all(0 <= r.taken <= 2 * r["size"] for r in docs_)
    draws = made.draws.join(made.sizes.select("row", "source"), "row").collect()
    taken = defaultdict(int)
    for r in draws:
        taken[r.source] += r.taken
    assert {s: taken[s] for s in sizes} == {s: math.floor(float(t) + 0.5) for s, t in want.items()}
    assert len({(r.row, r.block, r["round"]) for r in draws}) == len(draws)
    loads = [sum(r.shard == k for r in draws) for k in range(7)]
    assert max(loads) - min(loads) <= 1 and sum(loads) == len(draws)


def test_the_same_again_and_for_empty_tables(spark):
    rows, frame = corpus(spark)
    recipe = mix.Recipe(words=64, shards=5)
    view = lambda m: sorted(map(str, m.draws.where("doc_id is not null and doc_id <> 7").select("doc_id", "block", "round", "taken", "shard", "place").collect()))
    first = view(mix.mix(frame, recipe))
    assert first == view(mix.mix(frame.repartition(3), recipe)) and first != view(mix.mix(frame, mix.Recipe(words=64, shards=5, seed=1)))
    for empty in (docs(spark, []), docs(spark, [(1, None), (2, "")])):
        made = mix.mix(empty)
        assert made.draws.collect() == [] and [r.taken for r in mix.per_document(made).collect()] == [0] * empty.count()


def test_order_of_blocks_and_prefixes(spark):
    """A source of one document a block gives its documents in the order of their keys."""
    frame = spark.createDataFrame([(i, "x y", "a" if i % 3 else "b") for i in range(90)], "doc_id long, text string, source string")
    got = {r.doc_id: r.taken for r in mix.per_document(mix.mix(frame, mix.Recipe(weights=(1, 4), shards=3))).collect()}
    key = lambda i: hashlib.md5(f"42|{i}|0".encode()).hexdigest()[:16]
    for source, quota in (("a", 150), ("b", 120)):
        own = sorted((i for i in range(90) if (i % 3 > 0) == (source == "a")), key=key)
        want = {i: sum(min(2, max(0, quota - r * 2 * len(own) - 2 * k)) for r in range(2)) for k, i in enumerate(own)}
        assert {i: got[i] for i in own} == want


def test_texts_of_the_mix(spark):
    rows, frame = corpus(spark)
    recipe = mix.Recipe(words=16, shards=4)
    made = mix.mix(frame, recipe)
    got = mix.mixed_texts(frame, made)
    assert sum(len(r.text.split(" ")) for r in got.collect()) == sum(r.taken for r in made.draws.collect())
    held = got.withColumn("part", F.spark_partition_id()).collect()
    seen = defaultdict(list)
    for r in held:
        seen[r.shard].append((r.part, r.place))
    assert all(len({p for p, _ in x}) == 1 and [k for _, k in x] == sorted(k for _, k in x) for x in seen.values())


def test_hypergeometric_draws_follow_the_distribution():
    for good, bad, draws in ((5, 7, 6), (1, 30, 10), (40, 3, 20), (6, 6, 12), (0, 4, 2)):
        exact = {k: math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws) for k in range(draws + 1) if k <= good and draws - k <= bad}
        us = (np.arange(20_000) + 0.5) / 20_000
        got = defaultdict(int)
        for u in us:
            got[mix.hypergeometric(good, bad, draws, u)] += 1
        assert all(abs(got[k] / 20_000 - p) < 1e-4 for k, p in exact.items()) and set(got) <= set(exact)
    big = [mix.hypergeometric(3 * 10**10, 7 * 10**10, 10**9, u) for u in (0.001, 0.5, 0.999)]
    assert big == sorted(big) and abs(big[1] - 3 * 10**8) < 10 and 3.0 < (big[2] - big[1]) / math.sqrt(10**9 * 0.21 * 0.99) < 3.2


def test_dealt_tables_have_both_margins_and_fair_means():
    quotas, rooms = [50, 7, 0, 300, 1], [90, 90, 89, 89]
    tables = [mix.deal(quotas, rooms, seed, list(range(5))) for seed in range(400)]
    for t in tables:
        assert (t >= 0).all() and t.sum(1).tolist() == quotas and t.sum(0).tolist() == rooms
    mean = sum(tables) / len(tables)
    assert np.abs(mean - np.outer(quotas, rooms) / 358).max() < 1.0
    assert len({t.tobytes() for t in tables}) > 390


def test_more_sources_than_a_task_deals(spark, monkeypatch):
    monkeypatch.setattr(mix, "FAN", 4)
    quotas = [(p, p * 37 % 23) for p in range(70)]
    got = {r.pos: r.rooms for r in mix.shard_quotas(spark.createDataFrame(quotas, "pos long, quota long"), 6).collect()}
    assert {p: sum(x) for p, x in got.items()} == dict(quotas)
    loads = [sum(x[k] for x in got.values()) for k in range(6)]
    assert max(loads) - min(loads) <= 1

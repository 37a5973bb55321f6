import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from marajo.llm import repeats

from .common import AWKWARD, docs


def plain(rows, window):
    """Covered words by comparing all windows of all texts."""
    least = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            least[k] = min(least.get(k, i), i) if i is not None else least.get(k, 1 << 62)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and least[tuple(w[p : p + window])] < i:
                gone |= set(range(p, p + window))
        kept = [x for p, x in enumerate(w) if p not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(map(str, out))


def found(spark, rows, window):
    return sorted(str(tuple(r)) for r in repeats.dedup_substrings(docs(spark, rows), window).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def test_awkward_rows(spark):
    assert found(spark, AWKWARD, 50) == plain(AWKWARD, 50)
    assert found(spark, [], 50) == []


def test_random_texts_with_runs_and_periods(spark):
    r = random.Random(11)
    for window in (5, 50):
        rows = []
        for i in range(60):
            voc = r.choice([1, 2, 4, 300])
            words = [str(r.randrange(voc)) for _ in range(r.randrange(0, 160))]
            if rows and r.random() < 0.7:
                other = (r.choice(rows)[1] or "").split()
                at = r.randrange(len(other) + 1)
                words[10:10] = other[at : at + r.randrange(3 * window)]
            if r.random() < 0.3:
                words += words[:2] * r.randrange(60)
            rows.append((i, " ".join(words)))
        r.shuffle(rows)
        assert found(spark, rows, window) == plain(rows, window)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=5), st.integers(2, 12))
def test_equal_windows_hold_equal_symbols(texts, window):
    w = repeats.Words([" ".join(map(str, t)).encode() for t in texts])
    named, covered = {}, np.zeros(len(w.hash), int)
    for mine, name, low, high in repeats.symbols(w, window, 5):
        for p in np.flatnonzero(mine):
            text = w.text_of[p]
            words = tuple(texts[text][p - w.first[text] :][:window])
            inside = tuple(name[(low <= p) & (high >= p)])
            assert inside and named.setdefault(words, inside) == inside
            covered[p] += 1
    assert (covered == w.windows(window)).all()  # every window has just one level


def test_a_null_id_copy_in_a_step_hides_no_link(spark):
    passage = " ".join(f"p{i}" for i in range(80))
    near = docs(spark, [(None, passage), (1, passage)]).coalesce(1)
    far = docs(spark, [(2, f"other start {passage} other end")]).coalesce(1)
    found = repeats.dedup_substrings(near.unionByName(far)).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in found) == [("1", 0), ("2", 80), ("None", 0)]


def test_many_steps_in_a_task_remember_what_was_met(spark):
    r = random.Random(5)
    license_ = [f"l{i}" for i in range(70)]
    rows = []
    for i in r.sample(range(200), 120):
        words = [f"{i}w{k}" for k in range(r.randrange(60))]
        if r.random() < 0.6:
            words[5:5] = license_[: r.randrange(45, 71)]
        rows.append((i, " ".join(words)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        made = docs(spark, rows).coalesce(1)
        got = repeats.dedup_substrings(made, 50).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
        sent = repeats.name_symbols(made, 50).select("asks_for_all").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(str(tuple(x)) for x in got) == plain(rows, 50)
    asked = [s for x in sent for s in x.asks_for_all]
    assert len(asked) == len(set(asked))  # a shared symbol asks once a task


def test_seen_keeps_the_least_id_within_its_limit():
    seen = repeats.Seen(limit=4)
    seen.add(np.array([5, 9]), np.array([1, 1]), np.array([7, 3]))
    seen.add(np.array([5]), np.array([1]), np.array([2]))
    held, least = seen.look_up(np.array([9, 5, 1, 9]), np.array([1, 1, 1, 2]))
    assert held.tolist() == [True, True, False, False] and least[:2].tolist() == [3, 2]
    seen.add(np.array([1, 2, 3]), np.array([0, 0, 0]), np.array([1, 1, 1]))
    assert len(seen.hash) == 3

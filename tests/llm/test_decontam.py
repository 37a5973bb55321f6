import re

from hypothesis import given, settings
from hypothesis import strategies as st

from marajo.llm import decontam

from .common import docs

ITEMS = [(1, "The quick brown fox jumps over the lazy dog again and again today"), (2, "tiny item"), (3, None), (4, "..."), (None, "nobody owns this"), (2, "tiny item")]


def plain(text, items, window=10):
    """Hit word positions and item ids by looking for every window everywhere."""
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, ids = fold(text), set(), set()
    for i, t in items:
        x = fold(t)
        if i is None or not x:
            continue
        n = min(window, len(x))
        for s in {tuple(x[k : k + n]) for k in range(len(x) - n + 1)}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) == s:
                    hit |= set(range(p, p + n))
                    ids.add(i)
    return len(w), hit, ids


def spread(spans):
    return {p for s in spans for p in range(s["start"], s["end"])}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=4), st.lists(st.sampled_from("abc"), max_size=40), st.integers(2, 5))
def test_automaton_equals_search(items, words, window):
    rows = [(k, " ".join(i)) for k, i in enumerate(items)]
    a = decontam.build([(k, t.encode()) for k, t in rows], window)
    spans, ids = a.match([w.encode() for w in words])
    n, hit, want = plain(" ".join(words), rows, window)
    assert {p for s, e in spans for p in range(s, e)} == hit and ids == want


def test_a_long_item_is_cut_into_blocks_that_lose_no_window(spark):
    words = [f"w{i}" for i in range(100)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[40:70]))], "item_id long, text string")
    rows = [(k, " ".join(words[k : k + 10])) for k in range(91)] + [(200, " ".join(words[3:12]))]
    assert len(decontam.shelve(items, 10, 25)) > 2
    for r in decontam.matches(docs(spark, rows), items, block_words=25).collect():
        held = [] if r.doc_id == 200 else [1, 2] if 40 <= r.doc_id <= 60 else [1]
        assert sorted(r.item_ids) == held and sum(s.end - s.start for s in r.spans) == (10 if held else 0)


TEXTS = [
    (1, "x QUICK brown fox jumps, over the lazy dog again and again; tiny... item é y"), (2, None), (3, ""), (4, "tiny item tiny"), (5, "clean text here"), (5, "clean text here"),
    (None, "tiny item"), (6, "quick brown " * 5000 + "the quick brown fox jumps over the lazy dog again"),
]


def test_spans_and_items_of_awkward_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted(repr((i, n, sorted(hit), sorted(ids))) for i, t in TEXTS for n, hit, ids in [plain(t, ITEMS)])
    for block in (100_000, 10, 1):  # one automaton, two, or one a stretch of ten words
        rows = decontam.matches(docs(spark, TEXTS), items, block_words=block).collect()
        assert sorted(repr((r.doc_id, r.n_words, sorted(spread(r.spans)), sorted(r.item_ids))) for r in rows) == want
    assert decontam.matches(docs(spark, []), items).collect() == []
    assert all(not r.spans for r in decontam.matches(docs(spark, TEXTS), items.limit(0)).collect())


def test_cut_texts_hold_no_window_and_clean_rows_stay(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    given = docs(spark, TEXTS)
    assert decontam.decontaminate(docs(spark, []), items).collect() == []
    assert sorted(map(str, decontam.decontaminate(given, items.limit(0)).collect())) == sorted(map(str, given.collect()))
    several = decontam.decontaminate(given, items, block_words=1)
    out = decontam.decontaminate(given, items)
    assert out.columns == given.columns
    assert sorted(map(str, several.collect())) == sorted(map(str, out.collect()))
    by = sorted(str((r.doc_id, r.text)) for r in out.where("doc_id <> 6 or doc_id is null").collect())
    # documents 1, 4 and the one without an id are mostly benchmark
    assert by == sorted(map(str, [(2, None), (3, ""), (5, "clean text here"), (5, "clean text here")]))
    long = out.where("doc_id = 6").first().text
    assert "lazy" not in long and long.startswith("quick brown quick")

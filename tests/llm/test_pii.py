import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marajo.llm import pii

from .common import AWKWARD, docs

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))) or (kind == "card" and 13 <= len(d) <= 19 and luhn(d)) or (kind == "phone" and 9 <= len(d) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def found(spark, texts):
    rows = pii.mentions(docs(spark, list(enumerate(texts)))).collect()
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in rows}


TRICKY = [
    "a_x@d.e a@b.c_x@d.e é 1.2.3.4.5.6.7.8 4381893557741609-1 0001.2.3.4 999.1.1.1 +1 (234) 567-8901.",
    "1" * 60_000 + " " + "a." * 30_000 + "@b.c 4 3 8 1 8 9 3 5 5 7 7 4 1 6 0 9",
    "+" * 50 + "12345678901 x@y x@y.z. 1.2.3 \U0001f600 +34 600 600 600",
    "@".join(["ab.cd"] * 300),
    "4111-1111-1111-1111 4111 1111 1111 1112 256.1.1.1 000256.1.1.1",
]


def test_tricky_and_awkward_texts(spark):
    texts = TRICKY + [t for _, t in AWKWARD]
    assert found(spark, texts) == {i: plain(t) for i, t in enumerate(texts)}
    assert pii.find(docs(spark, [])).collect() == []


def test_random_texts(spark):
    texts = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(st.text(alphabet="a1.2@+-( )é9_", max_size=40))
    def gather(t):
        texts.append(t)

    gather()
    assert found(spark, texts) == {i: plain(t) for i, t in enumerate(texts)}


def test_disclosing_terms_are_found_and_generalised(spark):
    rows = [(i, f"note{i} {'x' * (i % 7 + 1)} Zorblatt+Fx wrote from bob@ex.org today{i}") for i in range(12)] + [(100 + i, f"plain text number {i} with nothing") for i in range(400)] + [(900, "see Zorblatt+Fx there")]
    frame = docs(spark, rows)
    terms = pii.disclosing_terms(frame, pii.mentions(frame), bits=4.0).collect()
    assert {r.term for r in terms} == {"Zorblatt+Fx", "wrote", "from"}
    assert pii.disclosing_terms(docs(spark, []), pii.mentions(docs(spark, []))).collect() == []
    clean = {r.doc_id: r.text for r in pii.sanitise(frame, bits=4.0).collect()}
    assert clean[900] == "see <term> there" and clean[100] == rows[12][1] and clean[0] == "note0 x <term> <term> <term> <email> today0"
    gone = pii.sanitise(frame, generalise=False, bits=4.0).where("doc_id = 900").first().text
    assert gone == "see  there"


def test_spans_of_repeated_rows_and_null_ids_stay(spark):
    rows = [(1, "x a@b.cd"), (1, "x a@b.cd"), (None, "1.2.3.4"), (2, None)]
    out = pii.find(docs(spark, rows)).select("doc_id", F.size("spans").alias("n")).collect()
    assert sorted(map(str, ((r.doc_id, r.n) for r in out))) == sorted(map(str, [(1, 1), (1, 1), (None, 1), (2, 0)]))


def test_copies_of_a_leak_count_once(spark):
    leaks = [f"n{c}o Zorblatt told p{c}q bob@ex.org r{c}s" for c in "abc"]
    rows = [(i, leaks[i % 3]) for i in range(90)] + [(None, leaks[0])] + [(1000 + i, f"plain number {i} text") for i in range(400)]
    frame = docs(spark, rows)
    terms = pii.disclosing_terms(frame, pii.mentions(frame), bits=4.0).collect()
    assert {r.term for r in terms} == {"Zorblatt", "told"}
    assert all(abs(r.information - math.log2(403 / 3)) < 1e-9 for r in terms)


def test_mentions_in_one_text_are_one_and_null_ids_count(spark):
    rows = [(1, "u1 Quux a@b.cd v u2 Quux a@b.cd w u3 Quux a@b.cd z")] + [(None, f"Quux elsewhere {i}") for i in range(3)] + [(10 + i, f"x{i}") for i in range(99)]
    frame = docs(spark, rows)
    assert "Quux" not in {r.term for r in pii.disclosing_terms(frame, pii.mentions(frame), bits=1.0).collect()}
    rows = [(None, f"k{c} Flarp a@b.cd") for c in "xyz"] + [(10 + i, f"x{i}") for i in range(99)]
    frame = docs(spark, rows)
    assert {r.term for r in pii.disclosing_terms(frame, pii.mentions(frame), bits=4.0).collect()} == {"Flarp"}


def plain_terms(rows, support=3, reveal=0.5, bits=8.0, reach=8):
    """Disclosing terms by walking all distinct texts."""
    from collections import defaultdict

    texts = {t or "" for _, t in rows}
    joint, places, mentions = defaultdict(set), defaultdict(set), defaultdict(set)
    for t in texts:
        words = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^ \t\n\x0b\f\r]+", t)]
        for kind, s, e in plain(t):
            around = tuple([w for _, b, w in words if b <= s][-reach:] + [w for a, _, w in words if a >= e][:reach])
            mentions[kind, t[s:e]].add(t)
            for w in set(around):
                if len(w) > 1 and not re.search("[0-9@]", w):
                    joint[kind, t[s:e], w].add(t)
                    places[kind, t[s:e], w].add(around)
    df = {w: sum(w in re.split(r"[ \t\n\x0b\f\r]+", t) for t in texts) for _, _, w in joint}
    out = set()
    for (kind, entity, w), own in joint.items():
        given = len(own) / df[w]
        if len(places[kind, entity, w]) >= support and given >= reveal and math.log2(given * len(texts) / len(mentions[kind, entity])) >= bits:
            out.add(w)
    return out


def test_terms_equal_a_walk_over_all_texts(spark):
    import random

    r = random.Random(11)
    people = {"ann@x.org": "Quill", "bob@y.net": "Vexa", "+34 600 600 601": "Tarn", "10.0.0.7": "Moss"}
    common = [f"c{chr(97 + i)}d" for i in range(20)]
    rows = []
    for i in range(700):
        words = r.choices(common, k=r.randrange(3, 30))
        if i % 6 == 0:
            entity = r.choice(list(people))
            at = r.randrange(len(words))
            words[at:at] = [r.choice(["", "("]) + entity + r.choice(["", ","]), people[entity]] if i % 4 else [people[entity] if i % 8 else "Shared", entity]
        rows.append((i, r.choice([" ", "\n", "  "]).join(words)))
    rows += [(1000 + i, rows[6 * i][1]) for i in range(30)] + [(None, rows[12][1]), (None, None), (2000, "")]
    frame = docs(spark, rows)
    for reveal, bits in ((0.5, 3.0), (0.9, 4.0)):
        got = {x.term for x in pii.disclosing_terms(frame, pii.mentions(frame), reveal=reveal, bits=bits).collect()}
        assert got == plain_terms(rows, reveal=reveal, bits=bits) and got
    spans = {(x.doc_id, s.start, s.end) for x in pii.find(frame, bits=3.0).collect() for s in x.spans if s.kind == "term"}
    terms = plain_terms(rows, bits=3.0)
    assert spans == {(i, m.start(), m.end()) for i, t in rows for m in re.finditer(r"[^ \n]+", t or "") if m[0] in terms}


def test_a_text_of_a_hundred_thousand_numbers_takes_seconds(spark):
    import time

    text = " ".join(str(10 + i % 90) for i in range(100_000)) + " " + " ".join(f"u{i}@ex.org" for i in range(3000))
    start = time.time()
    row = pii.mentions(docs(spark, [(1, text)])).select(F.size("base").alias("n"), F.element_at("base", -1).alias("last")).first()
    assert row.n == 3000 and row.last.around[-1] == "u2998@ex.org" and time.time() - start < 30


def test_ties_between_entities_and_overlapping_spans(spark):
    rows = [(i, f"a{'bcd'[i % 3]}e Twin a@x.org near b@y.org f{'ghi'[i % 3]}j") for i in range(3)] + [(100 + i, f"other text {i}") for i in range(400)]
    frame = docs(spark, rows)
    terms = {r.term: r.entity for r in pii.disclosing_terms(frame, pii.mentions(frame), bits=3.0).collect()}
    assert terms == {"Twin": "b@y.org", "near": "b@y.org"}  # equally telling: the last value
    # the number is a card and part of a phone number, and the address a term too
    text = "call +4111111111111111 now, card 4111-1111-1111-1111 of a@b.cd"
    assert [(s.kind, s.value) for s in pii.mentions(docs(spark, [(1, text)])).first().base] == [("email", "a@b.cd"), ("card", "4111111111111111"), ("card", "4111-1111-1111-1111")]
    assert pii.sanitise(docs(spark, [(1, text)])).first().text == "call +<card> now, card <card> of <email>"
    both = "x 1.2.3.4+12345678901 y"
    assert {s.kind for s in pii.mentions(docs(spark, [(1, both)])).first().base} == {"ip", "phone"}
    assert pii.sanitise(docs(spark, [(1, both)])).first().text == "x <ip><phone> y"
    assert pii.sanitise(docs(spark, [])).collect() == []


def test_sanitising_long_and_clashing_rows(spark):
    rows = [*AWKWARD, (50, "z " * 30_000 + "mail a@b.cd end")]
    out = {(r.doc_id, r.text) for r in pii.sanitise(docs(spark, rows)).collect()}
    assert out == {*AWKWARD, (50, "z " * 30_000 + "mail <email> end")}
    assert pii.sanitise(docs(spark, rows)).columns == docs(spark, rows).columns


def test_terms_of_given_texts_equal_the_sql_at_lower_thresholds(spark):
    import duckdb

    from marajo.llm import queries

    path = "/root/testdata/sf0.001/documents.parquet"
    sql = queries.OP7_SQL.replace("count(distinct around) >= 3", "count(distinct around) >= 1").replace("joint / df >= 0.5", "joint / df >= 0.2").replace(">= 8),", ">= 2),", 1)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{path}'")
    want = {i: s for i, s in con.sql(f"select doc_id, spans from ({sql})").fetchall()}
    found = pii.find(spark.read.parquet(path), support=1, reveal=0.2, bits=2.0)
    got = {r.doc_id: r.told for r in found.select("doc_id", queries._told("spans").alias("told")).collect()}
    assert got == want and sum("term:" in s for s in got.values()) > 20


def test_many_terms_give_the_same_spans(spark, monkeypatch):
    frame = docs(spark, [(k, f"{('Zorblat', 'Quenlo', 'Marfil')[k % 3]} spoke {k} {k + 1} of it, mail person{k % 3}@example.org now {'x' * (k % 5)} tail{k}") for k in range(30)] + [(100 + k, f"filler text {k}") for k in range(60)])
    limits = {"bits": 1.0, "reveal": 0.3, "support": 2}
    view = lambda: sorted(map(str, pii.find(frame, **limits).select("doc_id", "spans").collect()))
    want = view()
    assert any("term" in x for x in want)
    monkeypatch.setattr(pii, "FEW_TERMS", 0)
    assert view() == want
    monkeypatch.setattr(pii, "BROADCAST_TERMS", -1)
    assert view() == want
    plan = pii.disclosing_terms(frame, pii.mentions(frame), **limits)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

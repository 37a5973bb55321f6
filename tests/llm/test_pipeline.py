import hashlib

import corpus_pipeline
from marajo.llm import pieces
from marajo.llm.queries import PIECE_MODEL

from .test_decontam import plain as plain_hits
from .test_jaccard import plain_kept
from .test_lines_quality_shards import plain_lines

SF = "/root/testdata/sf0.001"


def test_each_stage_equals_brute_force_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "encoding"]

    good = stages["quality_rules"](spark, docs, SF).cache()
    assert good.columns == columns
    for r in docs.join(good, "doc_id", "left_anti").collect():  # too few labels here: base rules only
        w = r.text.split()
        seen = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        covered = {p for i, x in enumerate(seen) if seen.count(x) > 1 for p in range(i, i + 8)}
        assert len(w) < 20 or 100 * len(covered) > 30 * len(w)

    lean = stages["line_dedup"](spark, good, SF).cache()
    want = plain_lines([(r.doc_id, r.text) for r in good.collect()])
    assert sorted((r.doc_id, r.text) for r in lean.collect()) == sorted((i, t) for i, t, _ in want)
    assert all(r.n_chars == len(r.text) for r in lean.collect())

    single = stages["near_dedup"](spark, lean, SF).cache()
    assert sorted(r.doc_id for r in single.collect()) == plain_kept([(r.doc_id, r.text) for r in lean.collect()])

    clean = stages["decontamination"](spark, single, SF).cache()
    assert clean.columns == columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id: r.text for r in clean.collect()}
    for r in single.limit(40).collect():
        n, hit, _ = plain_hits(r.text, items)
        assert (r.doc_id in kept) == (len(hit) <= 0.5 * n)
        if not hit:
            assert kept[r.doc_id] == r.text

    ids = {r.doc_id: r for r in stages["encoding"](spark, clean, SF).collect()}
    assert ids.keys() == kept.keys() and all(r.lossless for r in ids.values())
    v = pieces.load(PIECE_MODEL)
    assert all(hashlib.md5(pieces.decode_ids(v, r.ids)).digest() == hashlib.md5(kept[i].encode()).digest() for i, r in ids.items())


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_pieces", "ids", "lossless"] and out.count() > 0

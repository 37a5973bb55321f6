import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from marajo.llm import merkle

from .common import AWKWARD, docs


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    """Levels from the leaves to the single node, by sixteens."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def plain_way(levels, at):
    way = []
    for level in levels[:-1]:
        run = at // 16 * 16
        way.append((level[run:at], level[at + 1 : run + 16]))
        at //= 16
    return way


def plain_check(rows):
    """(owner, doc_id, leaf, changed) to the expected rows, tree by tree."""
    owners = sorted({r[0] for r in rows}, key=lambda o: (o is not None, (o or "").encode()))
    held = {o: sorted((r for r in rows if r[0] == o), key=lambda r: (r[1] is not None, r[1] or 0, r[2])) for o in owners}
    trees = {o: plain_tree([r[2] for r in rs]) for o, rs in held.items()}
    top = plain_tree([trees[o][-1][0] for o in owners])
    root, out = top[-1][0], []
    for k, o in enumerate(owners):
        for at, (_, doc_id, leaf, changed) in enumerate(held[o]):
            way = plain_way(trees[o], at) + plain_way(top, k)
            folded, proof = changed or leaf, ""
            for before, after in way:
                folded = h(*before, folded, *after)
                proof += "".join(before + after)
            out.append((doc_id, leaf, trees[o][-1][0], root, h(proof), folded, folded == root))
    return sorted(out, key=str)


def check(spark, rows):
    tree = merkle.build(spark.createDataFrame(rows, "owner string, doc_id long, leaf string, changed string"))
    return tree, sorted((tuple(r) for r in merkle.check(tree).collect()), key=str)


def leaves(counts, every=3):
    return [(o, i * 7 % 100_003, h(str(o), str(i)), h("x", str(i)) if i % every == 0 else None) for o, n in counts.items() for i in range(n)]


def test_trees_of_all_shapes(spark):
    rows = leaves({None: 1, "": 2, "a": 15, "b": 16, "c": 17, "d": 256, "e": 257, "é": 4096, "z": 4097, "zz": 8500})
    _, got = check(spark, rows)
    assert got == plain_check(rows)
    assert not any(r[-1] for r in got if r[0] is not None and r[5] != r[3])


def test_many_sources_make_a_tree_too(spark, monkeypatch):
    rows = leaves({f"s{k}": 1 + k % 3 for k in range(300)})
    assert check(spark, rows)[1] == plain_check(rows)
    monkeypatch.setattr(merkle, "BROADCAST_PATHS", -1)
    assert check(spark, rows)[1] == plain_check(rows)


def test_one_leaf_is_its_own_root_and_no_leaf_has_none(spark):
    for changed in (None, h("y")):
        _, got = check(spark, [("s", 1, h("x"), changed)])
        assert got == [(1, h("x"), h("x"), h("x"), h(), changed or h("x"), changed is None)]
    tree, got = check(spark, [])
    assert got == [] and tree.root is None and merkle.versions(tree).collect() == []


def test_rows_that_share_an_id_and_null_ids(spark):
    rows = [("s", i, h(str(k)), None) for k, i in enumerate([5, 5, None, None, 3])] + [("s", 5, h("0"), None)] * 20
    assert check(spark, rows)[1] == plain_check(rows)


def test_versions_own_their_ancestors_alone(spark):
    rows = leaves({"a": 4500, "b": 3, None: 40}, every=50)
    tree, got = check(spark, rows)
    copies = defaultdict(dict)
    for r in merkle.versions(tree).collect():
        copies[r.source, r.doc_id][r.level] = r.digest
    changed = {(o, i): c for o, i, _, c in rows if c}
    assert set(copies) == set(changed)
    heights = {"a": 4, "b": 1, None: 2}
    roots = {(r[0], r[1]): r[5] for r in got}
    leaf = {(o, i): x for o, i, x, _ in rows}
    for (o, i), own in copies.items():
        assert sorted(own) == list(range(1, heights[o] + 2))  # one more level over the sources
        assert own[max(own)] == roots[i, leaf[o, i]]


def test_digest_of_awkward_rows(spark):
    frame = docs(spark).select("doc_id", "text", merkle.digest(F.col("doc_id"), F.col("lang"), F.col("text")).alias("d"), "lang")
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    for r in frame.collect():
        assert r.d == h(part(r.doc_id), part(r.lang), part(r.text))
    assert len(AWKWARD) == frame.count()

"""Every SQL twin of the corpus queries over awkward rows, as the given texts hold few of these."""

import duckdb
import pytest

from marajo.llm import queries
from tests.test_oracles import rows

from .common import AWKWARD

MORE = ["a\rb c", "a b c", "x\x0by z w", "x y\x0cz w", "X Y\x1fZ w", "é b c d", "tab\tone two\r\nthree", "one two three four five six seven eight nine ten eleven", "quick brown fox\rjumps over the lazy dog again and again ok"]
WORDS = " ".join(f"w{i % 97}x{i % 89}" for i in range(700))
TEXTS = [t if t is None or len(t) < 5000 else WORDS for _, t in AWKWARD] + MORE + ["Mr. José <jose@example.com> +55 (61) 99999-0000 10.0.0.1 4111 1111 1111 1111", "ÀÉ Éclair éclair éclairs ÉCLAIR éclair éclair " * 4, "'quoted' \\ %_ \"x\" " * 3]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("twins")
    docs = [(i * 7, t, (None, "en", "de")[i % 3], (None, "", "s1", "é", "s2")[i % 5], None if i % 4 == 0 else i) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(2).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, "Jumps over the lazy dog again and again ok"), (2, None), (3, " \r "), (4, "two three four five six seven eight nine ten eleven"), (5, "z W")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0), (7, None, None), (None, 0, 0), (14, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(i, None, t and t * 60) for i, t in enumerate(TEXTS[:12])] + [(50, "u", "é\r\n" * 400), (51, "v", "é\r\n" * 400)], "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    turns = [(c, k, ("user", "assistant", "system")[k % 3], TEXTS[(c * 3 + k) % len(TEXTS)]) for c in range(6) for k in range(4)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{root}/conversations.parquet")
    return str(root)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_twin_on_awkward_rows(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "conversations"):
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    got = queries.queries()[name](spark, folder).toPandas()
    want = con.sql(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want) > 0
    assert rows(got) == rows(want)


def test_no_control_characters_in_sources():
    from pathlib import Path

    for path in Path(queries.__file__).parent.parent.rglob("*.py"):
        data = path.read_bytes()
        assert not [c for c in data if c < 32 and c != 10], path

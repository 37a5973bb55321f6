"""Behaviour that the SQL twins don't show: errors, invariants, awkward rows."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marajo.operators import checks as Q
from marajo.operators import loading as L
from marajo.operators import nested as N
from marajo.operators import tables as T
from marajo.plans import bulletins as B
from marajo.sources import files as S


def test_upsert_is_idempotent_and_refuses_or_settles_repeats(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, seq int")
    batch = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1), (None, "n", 1)], "k int, v string, seq int")
    once = L.upsert(target, batch, ["k"], "seq")
    want = {(1, "a"), (2, "d"), (3, "e"), (None, "n")}
    assert {(r.k, r.v) for r in once.collect()} == want and once.count() == 4
    keyed = batch.where("k is not null")
    assert {tuple(r) for r in L.upsert(L.upsert(target, keyed, ["k"], "seq"), keyed, ["k"], "seq").collect()} == {tuple(r) for r in L.upsert(target, keyed, ["k"], "seq").collect()}
    with pytest.raises(ValueError, match="repeats"):
        L.upsert(target, batch, ["k"], on_batch_duplicate="error")
    with pytest.raises(ValueError, match="order"):
        L.upsert(target, batch, ["k"])


def test_nulls_are_equal_when_deduplicating(spark):
    rows = spark.createDataFrame([(None, 2), (None, 1), ("x", 3)], "k string, n int")
    assert {tuple(r) for r in L.dedupe_keep_first(rows, ["k"], "n").collect()} == {(None, 1), ("x", 3)}


def test_append_without_keys_is_refused(spark):
    rows = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError, match="keys"):
        L.apply_load(L.LoadConfig("t", mode="append"), rows, rows)
    with pytest.raises(ValueError, match="silver or gold"):
        L.stamp(rows, "bronze")


def test_names_of_tables_and_columns(spark):
    assert [L.normal_name(x) for x in ("Ação  (R$)", "__a--b__", "É_1")] == ["ação_r", "a_b", "é_1"]
    long = "pasta comprida de verdade/arquivo.zip"
    files = spark.createDataFrame([("In/Dados 1.csv", 1), ("in/dados-1.csv", 2), (long + "::dir/um_nome_de_membro_bem_comprido_final.csv", 3)], "path string, processed_at int")
    names = [r.table_name for r in L.table_names(files).orderBy("processed_at").collect()]
    assert names[:2] == ["in_dados_1", "in_dados_1_0001"] and len(names[2]) <= 57 and names[2].endswith("final")


def test_latest_places_nulls_as_told(spark):
    rows = spark.createDataFrame([(1, None), (1, 5)], "k int, d int")
    assert T.latest_per_key(rows, "k", ["d"], "first").first().d is None
    assert T.latest_per_key(rows, "k", ["d"], "last").first().d == 5


def test_cross_of_more_than_a_row_is_refused(spark):
    for odd in (spark.range(2), spark.range(0)):
        with pytest.raises(Exception, match="single row"):  # when the job runs, nothing runs before
            T.cross_scalars(spark.range(1), odd.withColumnRenamed("id", "b")).collect()


def test_densify_has_every_combination_and_counts_the_rest(spark):
    facts = spark.createDataFrame([("a", "x", 1), ("b", "q", 2), ("b", None, 3)], "k string, c string, n int")
    grid = T.densify(facts, "k", "c", ["x", "y"], ["n"])
    assert {tuple(r) for r in grid.select("k", "c", "n").collect()} == {("a", "x", 1), ("a", "y", 0), ("b", "x", 0), ("b", "y", 0)}
    assert T.unlisted(facts, "c", ["x", "y"]) == 2


def test_zero_and_null_bases_give_no_change(spark):
    rows = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, None), (4, 6.0), (5, 9.0)], "t int, v double")
    assert [r.c for r in T.pct_change(rows, "v", "t", 1, name="c").orderBy("t").collect()] == [None, None, None, None, 50.0]
    assert T.compound_rates(spark.createDataFrame([(1, 0.1), (2, 0.1)], "t int, r double"), "r", "t", 2, name="c").orderBy("t").collect()[1].c == pytest.approx(0.21)


def test_flattening_goes_all_the_way_down(spark):
    row = spark.createDataFrame([((1, ("x", [1, 2])),)], "a struct<b:int,c:struct<d:string,e:array<int>>>")
    assert [tuple(r) for r in N.flatten_nested(row).collect()] == [(1, "x", "[1,2]")]


def test_childless_parents_stay_or_go(spark):
    xml = "<r><p><n>1</n><c><k>a</k></c><c><k>b</k></c></p><p><n>2</n></p></r>"
    frame = spark.createDataFrame([(xml,), (None,), ("",)], "x string")
    rows = lambda keep: sorted((r.n, r.c__k or "") for r in N.xml_parent_child(frame, "x", "p", ["n"], "c", ["k"], keep_childless=keep).collect())
    assert rows(True) == [("1", "a"), ("1", "b"), ("2", "")] and rows(False) == [("1", "a"), ("1", "b")]


def test_dialects(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Nome;Valor;Nome\nJosé;1;x\n".encode())
    (tmp_path / "b.csv").write_bytes("Nome,Valor\nJosé,2\n".encode("latin-1"))
    (tmp_path / "c.txt").write_bytes("Nome|Valor|\nAna|3|\n".encode())
    (tmp_path / "d.txt").write_bytes("Nome\tValor\nEva\t4\n".encode())
    rows = S.read_delimited_drop(spark, str(tmp_path / "*"))
    assert {(r.nome, r.valor) for r in rows.collect()} == {("José", "1"), ("José", "2"), ("Ana", "3"), ("Eva", "4")}
    assert "nome_1" in rows.columns and not any(c.startswith("unnamed") for c in rows.columns)
    lines = S.numbered_lines(spark, str(tmp_path / "a.csv"))
    assert [r.text for r in S.positional(lines, {0: "nome"}, 1, ";", 3).withColumn("text", F.concat_ws("/", "nome", "col_1", "col_2")).collect()] == ["José/1/x"]


def test_empty_input_writes_nothing(spark, tmp_path):
    out = str(tmp_path / "o")
    assert S.to_staging(spark.createDataFrame([], "a string"), "frame", {}, out) is False
    assert not (tmp_path / "o").exists()


def test_differences_add_up(spark):
    old = spark.createDataFrame([("a/x", 1, 1), ("a/y", 2, 1), ("a/z", 3, 1), ("a/w", 4, 1)], "path string, size long, mtime long")
    new = spark.createDataFrame([("b/x", 1, 9), ("a/y", 2, 2), ("a/z", 3, 1), ("bak/z", 3, 5), ("n", 9, 9)], "path string, size long, mtime long")
    diff = Q.diff_snapshots(old, new)
    assert diff.count() == 7
    row = Q.summarize_changes(diff).first()
    assert (row.modified, row.moved, row.copied, row.added, row.removed, row.unchanged) == (1, 1, 1, 1, 1, 1)
    assert row.pattern == "overwrite, archive by move, archive by copy, delete"
    assert Q.diff_snapshots(old, new, compare_mtime=False).where("status = 'modified'").count() == 0
    assert Q.summarize_changes(Q.diff_snapshots(old, old)).first().pattern == "nothing changed"


def test_series_pipelines_on_literal_rows(spark):
    icst = spark.createDataFrame([("01/2024", "90,0", "100,0"), ("02/2024", "99,0", "0,0"), ("03/2024", "x", "50,0")], "mes string, icst_com_ajuste_sazonal string, icst_sem_ajuste_sazonal string")
    rows = B.confidence(icst).orderBy("data_referencia").collect()
    assert [r.icst_com_ajuste_sazonal for r in rows] == [90.0, 99.0, None] and [r.var_mes for r in rows] == [None, -100.0, None]
    names = ", ".join(f"{c} string" for c in B.SAVINGS)
    savings = B.savings(spark.createDataFrame([(f"2024-{m:02d}-01", "1", "x", str(1000.0 * m), "", None, "1.0") for m in range(1, 13)], f"data_referencia string, {names}"))
    last = savings.orderBy(F.desc("data_referencia")).first()
    assert (last.captacao_liquida_bi, last.captacao_acum_12m, last.retirada) == (12.0, 78_000.0, None)
    table = B.savings_periods(savings, [("DEZ 24", "2024-12-01", "2024-12-01"), ("12 MESES", "2024-01-01", "2024-12-01")]).collect()
    assert [tuple(r) for r in table] == [(1, "DEZ 24", 12.0), (2, "12 MESES", 78.0)]
    survey = spark.createDataFrame([("202403", "47949", "10", 1), ("202403", "47946", "100", 2), ("202404", "47949", "...", 3)], "periodo string, categoria_id string, valor string, dt_ingest int")
    wide = B.labour_survey(survey, "ocupados").orderBy("periodo").collect()
    assert (wide[0].ocupados_construcao, wide[0].ocupados_total, wide[0].dt_ingest, wide[1].ocupados_construcao) == (10.0, 100.0, 2, None)
    ticket = spark.createDataFrame([("MRV", 2020, 4, 1.0, 2.0), ("MRV", 2024, 1, 1.25, 50.04)], "empresa string, ano int, trimestre int, var_tri double, acum double")
    cost = B.cost_index(spark.createDataFrame([("12/2020", "10", "", "", ""), ("03/2024", "12", "", "", "")], "mes string, indice string, var_mes string, var_ano string, var_12_meses string"))
    got = B.ticket_against_cost(ticket, cost, "2020-12-01", (2023, 4)).collect()
    assert [(r.ano, r.mrv_acum_4t20, r.incc_acum_4t20, r.dir_var_tri) for r in got] == [(2024, 50.0, 20.0, None)]


def test_fund_totals_need_the_first_two_bands(spark):
    must, may = B.FUND_VALUES
    schema = ", ".join(f"{c} int" for c in (*must, *may))
    rows = spark.createDataFrame([(1, 2, None, 4, None, None), (None, 2, 3, 4, 5, 6)], schema)
    assert [r.valor_total_calculado for r in B.fund_loans(rows).collect()] == [7, None]


def test_reports_come_in_their_order(spark):
    """What the SQL twins can't show, as both sides are compared as sets."""
    rows = spark.createDataFrame([("b", 1), ("x", 2), ("a", 3), (None, 4)], "r string, n int").repartition(3)
    assert [r.n for r in T.order_by_rank(rows, "r", ["a", "b"]).collect()][:2] == [3, 1]
    lookup = spark.createDataFrame([("b", 9), ("x", 1), ("a", 5)], "r string, o int")
    assert [r.n for r in T.order_by_lookup(rows.where("r is not null"), lookup, "r", "o").collect()] == [2, 3, 1]
    days = spark.createDataFrame([(f"2024-0{m}-01", m if m != 2 else None) for m in (3, 1, 2, 5, 4)], "d string, v int").repartition(3)
    assert [r.v for r in T.series_slice(days, F.to_date("d"), ["v"]).collect()] == [5, 4, 3, 1]
    assert [r.v for r in days.orderBy(F.desc("v")).collect()] == [5, 4, 3, 1, None]
    assert [r.v for r in T.top_n(days, "v", 2).collect()] == [5, 4]
    quarters = spark.createDataFrame([("p", 2023, "4T"), ("q", 2024, "2T"), ("r", 2024, "1T")], "periodo string, ano int, trimestre string")
    for c in B.QUARTERLY_SLICES["financiamentos_habitacionais"].values():
        quarters = quarters.withColumn(c, F.lit(1))
    assert [r.periodo for r in B.quarterly_slice(quarters, "financiamentos_habitacionais").collect()] == ["q", "r", "p"]
    months = spark.createDataFrame([("12/2023", 1), ("02/2024", 2), ("01/2024", 3)], "mes string, indice int").withColumns({c: F.lit(0) for c in ("var_mes", "var_ano", "var_12_meses")})
    assert [r.mes for r in B.direct_series(months, "incc_m").collect()] == ["02/2024", "01/2024", "12/2023"]  # not by text


def test_every_load_target_settles(spark):
    """A target of each kind of load takes a batch, and the same batch again without change."""
    assert len({c.target for c in L.LOADS}) == len(L.LOADS) and all(bool(c.keys) == (c.mode in ("upsert", "drop_upsert")) for c in L.LOADS)
    kinds = {(c.mode, c.gate, c.batch_keep, bool(c.explode)): c for c in L.LOADS}
    for config in kinds.values():
        keys = list(config.keys) or ["a", "b"]
        if config.gate and config.gate[0] not in keys:
            keys.append(config.gate[0])
        schema = ", ".join(f"{k} string" for k in keys) + ", v int, dt_ingest int"
        target = spark.createDataFrame([(*["t"] * len(keys), 0, 0)], schema)
        batch = spark.createDataFrame([(*["t"] * len(keys), 1, 1), (*["u"] * len(keys), 2, 1), (*["u"] * len(keys), 3, 2)], schema)
        if config.explode:
            batch = batch.groupBy(F.lit("parent").alias("parent")).agg(F.collect_list(F.struct(*batch.columns)).alias(config.explode))
        if config.mode == "append":
            with pytest.raises(ValueError, match="append"):
                L.apply_load(config, target, batch)
            continue
        once = L.apply_load(config, target, batch)
        twice = L.apply_load(config, once, batch)
        values = lambda df: sorted(r.v for r in df.collect())
        found = values(once)
        assert values(twice) == found
        if config.gate:  # no row of the batch is of this century
            assert found == [0]
        elif config.mode in ("upsert", "drop_upsert"):
            assert found == ([1, 2] if config.batch_keep == "first" else [1, 3]), config


def test_a_failed_swap_keeps_the_old_data(spark, tmp_path):
    out = str(tmp_path / "data")
    L.full_refresh(spark.createDataFrame([(1,)], "a int"), out)
    L.full_refresh(spark.createDataFrame([(2,), (3,)], "a int"), out + "/")
    assert sorted(r.a for r in spark.read.parquet(out).collect()) == [2, 3]
    assert [p.name for p in tmp_path.iterdir()] == ["data"]


def test_drops_of_several_dialects_in_one_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("\ufeffId;Nome;nome\n1;ação;x\n2;sem fim\n3;\"a;b\";z\n".encode())
    (tmp_path / "b.csv").write_bytes("Nome,Id\r\né,4\r\n,5\r\n".encode("latin-1"))
    (tmp_path / "c.csv").write_bytes(b"Id\n")
    rows = S.read_delimited_drop(spark, str(tmp_path / "*.csv"))
    assert set(rows.columns) == {"id", "nome", "nome_1", "source_path"}
    got = sorted((r.id, r.nome, r.nome_1, r.source_path[-5:]) for r in rows.collect())
    assert got == [("1", "ação", "x", "a.csv"), ("3", "a;b", "z", "a.csv"), ("4", "é", None, "b.csv"), ("5", None, None, "b.csv")]


def test_lines_are_numbered_over_splits(spark, tmp_path):
    text = [f"linha {i} é ਊ" if i % 3 else "" for i in range(3000)]
    for encoding, java in (("utf-8", "utf-8"), ("utf-16", "utf-16")):
        path = tmp_path / f"{encoding}.txt"
        path.write_bytes("\r\n".join(text).encode(java))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        try:
            rows = S.numbered_lines(spark, str(path), encoding).orderBy("line_no").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert [r.line_no for r in rows] == list(range(1, 3001)) and [r.text for r in rows] == text


def test_sections_hold_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_LINES", 4)
    lines = [(1, "Sec: A"), (2, "skip"), *[(i, f"a{i}\tx") for i in range(3, 14)], (14, "Sec: B"), (15, "skip"), *[(i, f"b{i}\ty") for i in range(16, 20)]]
    rows = N.sectioned_report(spark.createDataFrame([("f", *x) for x in lines], "file string, line_no long, text string"), r"^Sec: (\w)", skip=1, min_cols=2).orderBy("line_no").collect()
    assert [(r.line_no, r.section) for r in rows] == [*[(i, "A") for i in range(3, 14)], *[(i, "B") for i in range(16, 20)]]


def test_written_tables_can_be_discarded_and_clusters_need_a_folder(spark):
    from types import SimpleNamespace

    from marajo import session

    session.discard_stashes(spark)
    held = session.stash(spark.range(3), "test")
    assert held.count() == 3 and session.discard_stashes(spark) == 1 and session.discard_stashes(spark) == 0
    with pytest.raises(Exception, match="(?i)not.*exist|PATH_NOT_FOUND|FileNotFound"):
        spark.read.parquet(held.inputFiles()[0]).count()
    root = Path(session.checkpoint_root(spark).removeprefix("file:").replace("//", "/"))
    others = set(root.glob("marajo-*"))  # of other processes
    mark = session.written_so_far()
    kept, gone = session.stash(spark.range(2), "kept"), session.stash(spark.range(2), "gone")
    rounds = session.settle(kept, before=gone)
    assert session.discard_stashes(spark, mark, keep=kept) == 1 and kept.count() == 2 and rounds is not kept
    session.discard_stashes(spark)
    assert set(root.glob("marajo-*")) == others
    unset = SimpleNamespace(isDefined=lambda: False)
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=SimpleNamespace(master="yarn", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: unset)))
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(cluster)

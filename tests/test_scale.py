"""Windows without a partition, loads that count, sources, ledgers, sinks."""

import random
import zipfile

import pytest
from pyspark.sql import functions as F

from marajo.operators import loading as L
from marajo.operators import observed as O
from marajo.operators import ordered, stored
from marajo.operators import tables as T
from marajo.sources import archives, files
from marajo.streaming import incremental as I


def series(spark, n=500):
    draw = random.Random(3)
    rows = [(draw.choice([None, *range(40)]), i, draw.choice([None, 0, *range(1, 9)])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "t int, i int, v int").repartition(5)


def test_ranged_windows_equal_a_walk(spark, monkeypatch):
    rows, frame = series(spark)
    placed = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for block in (7, 10_000):
        monkeypatch.setattr(ordered, "BLOCK_ROWS", block)
        for back in (1, 30):
            got = {r.i: r.s for r in T.rolling_sum(frame, "v", ["t", "i"], back, T.RANGED, "s").collect()}
            for k, (_, i, _) in enumerate(placed):
                seen = [v for _, _, v in placed[max(0, k - back + 1) : k + 1] if v is not None]
                assert got[i] == (sum(seen) if seen else None)
            changes = {r.i: r.c for r in T.pct_change(frame, "v", ["t", "i"], back, T.RANGED, name="c").collect()}
            for k, (_, i, v) in enumerate(placed):
                then = placed[k - back][2] if k >= back else None
                assert changes[i] == (pytest.approx((v / then - 1) * 100, abs=0.06) if v is not None and then else None)
    first = placed[0][2]
    got = {r.i: r.v_since_start for r in T.change_since_start(frame, "v", ["t", "i"], T.RANGED).collect()}
    assert all(got[i] == (pytest.approx((v / first - 1) * 100, abs=0.06) if v is not None and first else None) for _, i, v in rows)
    assert T.rolling_sum(frame.limit(0), "v", ["t", "i"], 3, T.RANGED, "s").collect() == []


def test_ranged_windows_need_no_single_partition(spark):
    plan = T.pct_change(series(spark)[1], "v", ["t", "i"], 1, T.RANGED)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" in plan


def test_positions_with_weights(spark):
    rows = [(g, random.Random(k).randint(0, 9), k) for k, g in enumerate([None, "a", "b", "a"] * 40)]
    frame = spark.createDataFrame(rows, "g string, w long, k int").repartition(3)
    for r in ordered.positions(frame, ["g"], ["k"], "w").collect():
        own = [x for x in rows if x[0] == r.g]
        assert (r.pos, r.of) == (sum(x[2] < r.k for x in own), len(own))
        assert (r.before, r.total) == (sum(x[1] for x in own if x[2] < r.k), sum(x[1] for x in own))


def test_load_counts_are_those_of_one_scan(spark, tmp_path):
    raw = spark.createDataFrame([("1", "2024-01-01", "k"), ("x", "None", "k"), (None, "n/a", None), (" ", "", "m"), ("1.5", "2024-13-01", "m")], "a string, d string, k string")
    columns = [(["a"], "a", F.col("a").try_cast("int")), (["d", "gone"], "day", F.try_to_date("d")), (["k"], "k", F.col("k"))]
    got = O.load_observed(raw, columns, str(tmp_path / "t"), ["k"])
    assert got == O.LoadCounts(5, {"a": 2, "day": 2, "k": 0}, 1, 2)
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "t")).columns)) == ["a", "day", "k"]
    assert O.load_observed(raw.limit(0), columns, str(tmp_path / "e")) == O.LoadCounts(0, {"a": 0, "day": 0, "k": 0}, 0, 0)


def test_enrich_refuses_parts_that_repeat_a_key(spark):
    base = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    part = spark.createDataFrame([(1, "a"), (3, "c"), (None, "x"), (None, "y")], "k int, v string")
    assert {tuple(r) for r in T.enrich(base, [(part, "k")]).collect()} == {(1, "a"), (2, None), (None, None)}
    twice = part.unionByName(part.where("k = 3"))
    with pytest.raises(Exception, match="more than one row of a key"):
        T.enrich(base, [(twice, "k")]).collect()
    assert T.enrich(base, [(twice, "k")], checked=False).count() == 3


def test_rename_plan_equals_a_walk(spark):
    draw = random.Random(11)
    for _ in range(2):
        names = [f"n{i}" for i in range(14)]
        wanted = draw.sample(names, 10)
        held = draw.sample(names, 10)
        ledger = [(f"{w}.csv", i, h) for i, (w, h) in enumerate(zip(wanted, held, strict=True))]
        existing = draw.sample(held, 8) + draw.sample([n for n in names if n not in held], 2)
        want, there = {}, set(existing)
        moves = {h: p.removesuffix(".csv") for p, _, h in ledger if p != f"{h}.csv" and h in there}
        for path, _, h in ledger:
            w, seen, now = path.removesuffix(".csv"), 0, h
            if w == h:
                want[path] = ("kept", None)
            elif h not in there:
                want[path] = ("skipped", None)
            else:
                while now in moves and seen <= 20:
                    now, seen = moves[now], seen + 1
                want[path] = ("conflict", None) if seen > 20 or now in there else ("renamed", seen - 1)
        plan = L.rename_plan(spark.createDataFrame(ledger, "path string, processed_at int, table_name string"), spark.createDataFrame([(n,) for n in existing], "table_name string"))
        assert {r.path: (r.outcome, r.step) for r in plan.collect()} == want
        for step in sorted({s for _, s in want.values() if s is not None}):  # carrying it out never meets a taken name
            for path, _, h in ledger:
                if want[path] == ("renamed", step):
                    assert path.removesuffix(".csv") not in there
                    there.remove(h)
                    there.add(path.removesuffix(".csv"))


def test_source_scans_cover_all_rows(spark, tmp_path):
    url = "jdbc:derby:memory:scan;create=true"
    rows = spark.createDataFrame([(i * i, f"n{i}") for i in range(-20, 200) if i >= 0] + [(None, "none"), (-5, "below")], "K long, NAME string")
    rows.write.jdbc(url, "SCANNED", mode="overwrite", properties={"createTableColumnTypes": "NAME VARCHAR(50)"})
    scan = files.scan_source(spark, url, "SCANNED", "K", tasks=5)
    assert scan.rdd.getNumPartitions() == 5 and sorted(map(str, scan.collect())) == sorted(map(str, rows.collect()))
    assert max(scan.groupBy(F.spark_partition_id()).count().collect())[1] < 100
    rows.limit(0).write.jdbc(url, "NONE_", mode="overwrite", properties={"createTableColumnTypes": "NAME VARCHAR(50)"})
    assert files.scan_source(spark, url, "NONE_", "K").collect() == []
    files.replicate(spark, url, {"SCANNED": ["K"]}, str(tmp_path), tasks=3)
    assert stored.read_stored(spark, f"{tmp_path}/SCANNED").count() == 202


def test_a_batch_that_fails_between_rows_and_ledger_is_repeated_whole(spark, tmp_path):
    drop, root, check = (str(tmp_path / n) for n in ("drop", "root", "check"))
    (tmp_path / "drop").mkdir()
    (tmp_path / "drop" / "a.csv").write_text("k;v\n1;x\n2;y\n")
    (tmp_path / "drop" / "b.csv").write_text("k;v\n3;z\n")

    def dies(number):
        raise OSError("lost")

    with pytest.raises(Exception, match="lost"):
        I.load_drop(spark, drop, "k string, v string", check, root, between=dies)
    assert I.read_ledger(spark, root).count() == 0
    I.load_drop(spark, drop, "k string, v string", check, root)
    (tmp_path / "drop" / "c.csv").write_text("k;v\n4;w\n")
    I.load_drop(spark, drop, "k string, v string", check, root)
    I.load_drop(spark, drop, "k string, v string", check, root)
    assert sorted(r.k for r in spark.read.parquet(f"{root}/rows").collect()) == ["1", "2", "3", "4"]
    assert sorted((r.path[-5:], r.n_rows) for r in I.read_ledger(spark, root).collect()) == [("a.csv", 2), ("b.csv", 1), ("c.csv", 1)]
    assert len({r.table_name for r in I.read_ledger(spark, root).collect()}) == 3


def test_members_of_archives(spark, tmp_path):
    for name, method in (("a.zip", zipfile.ZIP_DEFLATED), ("b.zip", zipfile.ZIP_STORED)):
        with zipfile.ZipFile(tmp_path / name, "w", method) as z:
            for i in range(12):
                z.writestr(f"d/{i}.csv", "id;note\n" + "".join(f'{name}{i}-{k};"l1\nl{k}"\n' for k in range(300)))
            z.writestr("d/.hidden.csv", "id;note\n0;0\n")
            z.writestr("empty.csv", "")
            z.writestr("readme.md", "#")
    found = archives.members(spark, str(tmp_path / "*.zip"))
    assert found.count() == 26 and all("::" in r.path for r in found.collect())
    ledger = found.where("member = 'd/3.csv'").select("path")
    fresh = found.join(ledger, "path", "left_anti").where("archive like '%a.zip'")
    lines = archives.member_lines(fresh, 8)
    assert lines.select(F.spark_partition_id()).distinct().count() > 3  # one archive, several tasks
    rows = files.delimited(lines).collect()
    assert len(rows) == 11 * 300 and {(r.id, r.note) for r in rows} == {(f"a.zip{i}-{k}", f"l1\nl{k}") for i in range(12) if i != 3 for k in range(300)}
    data = bytearray((tmp_path / "b.zip").read_bytes())
    at = data.find(b"b.zip7-1;")
    data[at : at + 9] = b"b.zip7-2;"
    (tmp_path / "b.zip").write_bytes(data)
    with pytest.raises(Exception, match="damaged"):
        archives.member_lines(found.where("archive like '%b.zip'")).count()


def test_a_document_is_whole_or_the_last_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "report.json")
    made = lambda n: files.report_document({"rows": spark.range(n).select("id")})
    files.write_document(made(2), path)
    assert (tmp_path / "report.json").read_text() == '{"rows":[{"id":0},{"id":1}]}\n'
    with pytest.raises(Exception, match="no report"):
        files.write_document(made(10_001), path)

    def dies(*_):
        raise OSError("lost")

    monkeypatch.setattr(files, "swap_in", dies)
    with pytest.raises(OSError, match="lost"):
        files.write_document(made(3), path)
    monkeypatch.undo()
    assert (tmp_path / "report.json").read_text() == '{"rows":[{"id":0},{"id":1}]}\n'
    files.write_document(made(1), path)
    assert (tmp_path / "report.json").read_text() == '{"rows":[{"id":0}]}\n' and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["report.json"]


def test_rename_plan_sends_no_side_through_the_driver(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(L, "stash", lambda df, name, held=L.stash: rounds.append((name, df)) or held(df, name))
    ledger = spark.createDataFrame([(f"c{i // 2}.csv" if i % 2 else f"b{i}.csv", i, f"a{i}") for i in range(600)], "path string, processed_at int, table_name string")
    plan = L.rename_plan(ledger, ledger.select("table_name"))
    assert plan.where("outcome = 'renamed' and step = 0").count() == 600
    assert not any("BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString() for df in [plan, *[f for _, f in rounds]])
    assert sum(name == "hops" for name, _ in rounds) <= 2  # the longest chain is one move

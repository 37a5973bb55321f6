"""Drops of delimited text: quotes, splits, dialects."""

import csv
import io
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from marajo.sources import files as S
from marajo.sources import quoted


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def by_duckdb(path, sep):
    rows = duckdb.sql(f"select * from read_csv('{path}', delim='{sep}', header=true, all_varchar=true, quote='\"', escape='\"', parallel=false, auto_detect=false, columns={{'id': 'varchar', 'note': 'varchar', 'tail': 'varchar'}})").fetchall()
    return sorted(map(str, rows))


def drop(seed, sep, n=150):
    draw = random.Random(seed)
    out = io.StringIO()
    out.write(f"id{sep}note{sep}tail\n")
    write = csv.writer(out, delimiter=sep, lineterminator="\n")
    for i in range(n):
        parts = draw.choices(["x" * draw.randint(0, 60), '"', "\n", sep, '""', "\n\n", "é", '"\n"', "plain words"], k=draw.randint(1, 7))
        write.writerow([i, "".join(parts) or "e", f"t{i}\n" if i % 11 == 0 else f"t{i}"])
    return out.getvalue()


@pytest.mark.parametrize("sep", [";", ",", "|", "\t"])
def test_quoted_line_feeds_across_splits_equal_another_reader(spark, tmp_path, small_splits, sep):
    want = []
    for seed in range(3):
        path = tmp_path / f"{seed}.csv"
        path.write_bytes(drop(seed, sep).encode())
        want += by_duckdb(path, sep)
    told = quoted.splits(quoted.raw_lines(spark, str(tmp_path / "*.csv")))
    assert told.count() > 40 and 0 < told.where("begins = 1").count() < told.count()
    rows = S.read_delimited_drop(spark, str(tmp_path / "*.csv")).select("id", "note", "tail")
    assert sorted(str(tuple(r)) for r in rows.collect()) == sorted(want)
    sides = told.withColumn("kind", F.lit(0))
    lines = quoted.raw_lines(spark, str(tmp_path / "*.csv"))
    texts = lambda ordered: sorted(bytes(r.text) for r in quoted.records(lines, F.broadcast(sides) if ordered else sides, ordered).collect())
    assert texts(True) == texts(False)


def test_a_record_longer_than_splits_and_one_never_closed(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(400))
    (tmp_path / "a.csv").write_bytes(f'id;note\r\n1;"{long}"\r\n2;"two\r\nlines"\r\n3;5" pipe\r\n4;plain\r\n'.encode())
    (tmp_path / "b.csv").write_bytes(("id;note\n5;before\n6;\"never closed\n" + "7;x\n" * 500).encode())
    (tmp_path / "c.csv").write_bytes('﻿"id";"note"\n8;"""q"""\n'.encode())
    got = sorted((r.id, r.note) for r in S.read_delimited_drop(spark, str(tmp_path / "*.csv")).collect())
    assert got == [("1", long), ("2", "two\r\nlines"), ("3", '5" pipe'), ("4", "plain"), ("5", "before"), ("8", '"q"')]


def test_line_maps():
    for line, both in ((b'a;"b', (1, 0)), (b'a;"b";"', (1, 1)), (b'"', (1, 0)), (b'""', (0, 1)), (b'x"y;z', (0, 0)), (b"plain", (0, 1)), (b'x";"y', (1, 1)), (b'a;b""c', (0, 1)), (b'"a""', (1, 0))):
        assert quoted.line_map(line, b";") == both, line
    assert quoted.line_map(b'"a,b', b",") == (1, 0) and quoted.line_map((b'"x""y",' * 5000) + b'"', b",")[0] == 1

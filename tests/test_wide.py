"""Typing of wide tables: work spread over all cores, no method too long to compile."""

import datetime

from marajo.functions import cleaning as C
from marajo.plans import kit, programme_queries, registry
from marajo.plans import programme_tables as R
from marajo.session import stash, unfused, written_so_far

SF = "/root/testdata/sf0.001"


def test_wide_raw_tables_are_made_by_all_cores(spark):
    raw = programme_queries.raw_table(kit.Tables(spark, SF), R.A["register"])
    assert raw.rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism


def test_wide_tables_are_typed_when_the_query_is_made(spark):
    found = registry.queries()["p38_bronze_register"](spark, SF)
    assert "regexp" not in found._jdf.queryExecution().executedPlan().toString()  # all that is left is to read them


def test_unfused_holds_inside_alone(spark):
    key = "spark.sql.codegen.wholeStage"
    before = spark.conf.get(key)
    with unfused(spark):
        assert spark.conf.get(key) == "false" and stash(spark.range(3), "three").count() == 3
    assert spark.conf.get(key) == before


def test_rejected_values_are_counted_without_a_copy_of_the_raw_tables(spark):
    mark = written_so_far()
    found = registry.queries()["g7_rejected_values"](spark, SF)
    assert found.count() == sum(map(len, R.A.values())) and written_so_far() == mark


def test_values_are_typed_without_parsers_that_fail(spark):
    texts = ["12", " +7 ", "-3\t", "x", "1.5", "", "None", "2147483648", "\u06633", "31/12/2020", "31/12/2020\n", "30/02/2020", "20201231", "20201231\n", "2020-12-31x", " 20201231", "2020123", None]
    held = spark.createDataFrame([(t,) for t in texts], "t string")
    found = held.select(C.parse_int("t").alias("i"), C.parse_date_br("t").alias("d"))
    plan = found._jdf.queryExecution().executedPlan().toString().lower()
    assert "gettimestamp" not in plan and "try_to_date" not in plan and "(t#" in plan and plan.count("rlike") == 4
    rows, day = found.collect(), datetime.date(2020, 12, 31)
    assert [r.i for r in rows] == [12, 7, -3] + [None] * 9 + [20201231, 20201231, None, 20201231, 2020123, None]
    assert [r.d for r in rows] == [None] * 9 + [day, None, None, day, None, day, None, None, None]

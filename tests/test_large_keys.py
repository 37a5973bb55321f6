"""Queries and their SQL on keys of large tables, and on values that round to nothing."""

from decimal import Decimal

import duckdb
import pytest

from marajo.plans import registry


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("large")
    con = duckdb.connect()
    con.execute("create table nation as select * from '/root/testdata/sf0.001/nation.parquet'")
    con.execute("create table region as select * from '/root/testdata/sf0.001/region.parquet'")
    con.execute("create table customer as select * from '/root/testdata/sf0.001/customer.parquet'")
    # keys in the tens of millions, and pairs whose keys differ by a million: equal days
    con.execute("""create table orders as select o.* replace (o_orderkey * 7 + 29000001 + i * 1000000 as o_orderkey, case when o_orderkey % 2 = 0 then timestamp '1995-01-01' else o_orderdate end as o_orderdate)
      from '/root/testdata/sf0.001/orders.parquet' o, range(4) r(i)""")
    con.execute("create table events as select i as event_id, timestamp '2020-01-01' + to_seconds(i) as ts, v as value from (select i, [100.0, 99.99, 99.99, 0.0, 50.0, 58.25, 20.0, 23.45][i % 8 + 1] as v from range(80) r(i))")
    for t in ("nation", "region", "customer", "orders", "events"):
        con.execute(f"copy {t} to '{root}/{t}.parquet'")
    return str(root), con


@pytest.mark.parametrize("name", "p31_entity_a p34_fact_sheet p36_state_panel p39_entity_b p41_fact_sheet_b w1_ranged_change w7_ranged_since_start".split())
def test_large_keys_equal_sql(spark, folder, tmp_path, name):
    root, con = folder
    registry.queries()[name](spark, root).write.parquet(str(tmp_path / "got"))
    con.execute(f"create or replace table wanted as {registry.oracle_sql()[name]}")
    columns = sorted(c[0] for c in con.execute("describe wanted").fetchall())
    cell = lambda v: str(float(v) if isinstance(v, Decimal) else v)
    text = lambda source: sorted([cell(v) for v in row] for row in con.execute(f"select {', '.join(columns)} from {source}").fetchall())
    assert text("wanted") == text(f"'{tmp_path}/got/*.parquet'")


def test_the_panels_sql_counts_works_without_a_state(folder):
    con = folder[1].cursor()
    con.execute("create temp table orders as select * from main.orders where false")  # no proposal: no state
    got = con.execute(f"select sum(qtd_empreendimentos) from ({registry.oracle_sql()['p36_state_panel']}) where uf is null and secao = 'situacao'").fetchone()[0]
    assert got == con.execute("select count(*) from customer where c_mktsegment in ('BUILDING', 'HOUSEHOLD')").fetchone()[0] > 0

"""How often the large tables are moved on their way into the marts."""

import datetime as dt
import re

import pytest

from tests.conftest import SF_SMALL
from vireo.plans import staging
from vireo.plans.star import MARTS_DIR, Star
from vireo.sources.tables import Sources


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_readings_shuffle_lines_and_orders_once(spark, no_broadcast):
    p = plan(staging.stg_readings(Sources.driver(spark, SF_SMALL)))
    assert len(re.findall(r"Exchange hashpartitioning\(", p)) == 2  # one for each table


def test_work_orders_are_added_up_without_sorting_lines(spark):
    p = plan(staging.stg_work_orders(Sources.driver(spark, SF_SMALL), Star.from_dir(spark, SF_SMALL).readings))
    assert "SortAggregate" not in p and "HashAggregate" in p


def test_facts_are_not_moved_to_be_laid_out(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame
    hints = []
    hint = DataFrame.hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda self, name, *a: hints.append(name) or hint(self, name, *a))
    spark.conf.set(MARTS_DIR, str(tmp_path / "marts"))
    try:
        assert Star.shared(spark, SF_SMALL).fct_work_orders.count() > 0 and "rebalance" not in hints
    finally:
        spark.conf.unset(MARTS_DIR)


def test_origin_is_the_dearest_line_and_the_first_of_equals(spark):
    """Null prices come last, and equal prices by line."""
    day = dt.datetime(1996, 3, 1)
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    prices = {1: {1: 5.0, 2: 9.99, 3: 9.99}, 2: {4: None, 2: None, 7: None}, 3: {1: None, 5: -3.0}, 4: {None: 8.0, 3: 2.0}}
    lines = [(o, 1, 1, n, 1.0, p, 0.0, 0.0, "R", "F", day) for o, own in prices.items() for n, p in own.items()]
    orders = [(o, 1, "F", 1.0, day, "1-URGENT") for o in prices]
    tables = {"lineitem": spark.createDataFrame(lines, columns), "supplier": spark.createDataFrame([(1, "s", 1, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
              "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")}
    src = Sources(spark, {name: (lambda t=t: t) for name, t in tables.items()})
    got = {r.order_no: r.origin_line for r in staging.stg_work_orders(src, staging.stg_readings(src)).collect()}
    assert got == {1: 2, 2: 2, 3: 5, 4: None}

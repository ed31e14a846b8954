"""The physical plans are the ones meant: pruned scans, no Python, no nested loops."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripweave.catalog import QUERIES
from tripweave.operators.search import SearchFilter
from tripweave.plans import marts, serving
from tripweave.plans.build import DEPENDENCIES
from tripweave.schema import FLIGHTS
from tripweave.sources import landing
from conftest import SF

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "NestedLoop"]


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", DEPENDENCIES)
def test_models_stay_in_the_engine(tables, name):
    plan = executed(tables.model(name))
    assert [word for word in FORBIDDEN if word in plan] == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(("exec_", "route_", "customer_", "cross_", "check_"))])
def test_queries_stay_in_the_engine(spark, name):
    plan = executed(QUERIES[name](spark, SF))
    assert [word for word in FORBIDDEN if word in plan] == []


def test_revenue_reads_three_columns_and_pushes_the_filter(tables):
    plan = executed(serving.revenue_by_type(tables.table("fact_bookings")))
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,completed)]" in plan
    assert "ReadSchema: struct<booking_type:string,amount_idr:bigint,status:string>" in plan


def test_lookup_by_hex_id_pushes_the_raw_key(tables):
    plan = executed(serving.customer_bookings(tables.table("fact_bookings"), "72635F" + "0" * 24))
    assert "EqualTo(resolved_customer_id,rc_" in plan


def test_customer_figures_use_hash_aggregation_with_one_shuffle(tables):
    plan = executed(marts.bookings_agg(tables.table("fact_bookings")))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_top_lists_keep_only_the_top(tables):
    assert "TakeOrderedAndProject" in executed(serving.top_customers(tables.table("dim_customer")))
    plan = executed(serving.recent_bookings(tables.table("fact_bookings")))
    assert plan.count("WindowGroupLimit") == 2


def test_search_does_not_shuffle_contact_lists(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # A page of ten rows passes Spark's size check, the customer table does not.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8192")
    try:
        where = SearchFilter(tiers=("gold",), omnichannel=True)
        mart, dim = tables.table("mart_customer_clv"), tables.table("dim_customer")
        plan = executed(serving.customer_search(mart, dim, where, limit=10))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "PushedFilters: [IsNotNull(loyalty_tier), EqualTo(loyalty_tier,gold)" in plan
    assert plan.count("BroadcastHashJoin") == 1 and "LeftSemi" in plan
    people = [line for line in plan.splitlines() if "FileScan" in line and "source_systems" in line]
    assert any("ReadSchema: struct<resolved_customer_id:string,source_systems" in line for line in people)


def test_search_without_identity_conditions_needs_no_semi_join(tables):
    mart, dim = tables.table("mart_customer_clv"), tables.table("dim_customer")
    assert "LeftSemi" not in executed(serving.customer_search(mart, dim, SearchFilter(tiers=("gold",))))
    assert "Join" not in executed(serving.customer_search_count(mart, dim, SearchFilter(has_ticket=True)))


def test_recent_tickets_rank_without_texts(tables):
    plan = executed(serving.recent_tickets(tables.table("dim_customer"), tables.table("silver_tickets")))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "body" in line]
    assert len(scans) == 1


def test_pages_keep_only_the_page(tables):
    plan = executed(landing.page(tables.landed("flights"), FLIGHTS, limit=10, offset=20))
    assert "TakeOrderedAndProject" in plan


def test_distinct_travelers_are_spread_by_traveler(tables):
    plan = executed(tables.model("mart_route_monthly"))
    assert any("resolved_customer_id" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_empty_tables_give_empty_marts(tables):
    fact = tables.table("fact_bookings").filter(F.lit(False))
    assert marts.bookings_agg(fact).count() == 0
    assert serving.type_gap(fact).count() == 0


def test_tables_that_do_not_need_each_other_are_built_side_by_side(spark, tmp_path, monkeypatch):
    from threading import Barrier

    from tripweave.plans import build

    deps = {"a": [], "b": [], "c": ["a", "b"], "d": ["a", "c"]}
    both, made = Barrier(2, timeout=20), []

    def model(self, name):
        if name in "ab":
            both.wait()  # breaks unless the two are under way at once
        assert sorted(self._tables(deps[name])) == deps[name]
        made.append(name)
        return self.spark.range(1)

    monkeypatch.setattr(build, "DEPENDENCIES", deps)
    monkeypatch.setattr(build.Warehouse, "model", model)
    w = build.Warehouse(spark, str(tmp_path))
    w.root = str(tmp_path / "w")
    w.build_all()
    assert sorted(made) == ["a", "b", "c", "d"] and made[-1] == "d"
    assert w.table("d").count() == 1 and len(made) == 4


def test_customers_are_dealt_before_they_are_cleansed(spark, tables):
    plan = tables.landed("customers")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan

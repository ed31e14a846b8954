"""Posting lists leave every customer that a search finds, and little else."""

from __future__ import annotations

import pytest

from tripweave.operators.search import matches_term
from tripweave.plans import search_index


@pytest.fixture(scope="module")
def index(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("postings"))
    search_index.write_postings(tables.table("dim_customer"), path)
    return search_index.read_postings(spark, path)


TERMS = ["wijaya", "WIJ", "wi%aya", "_ija%a", "628", "@gmail", ".com", "72635f", "rc_", "Rina", "an", "", "%", "a%b", "no such name", "%%%wij", "5c\\5f", "a_b%c"]


@pytest.mark.parametrize("term", TERMS)
def test_no_match_is_lost(tables, index, term):
    dim = tables.table("dim_customer")
    want = {r[0] for r in dim.filter(matches_term(term)).select("resolved_customer_id").collect()}
    few = search_index.reduced(dim, index, term)
    assert {r[0] for r in few.filter(matches_term(term)).select("resolved_customer_id").collect()} == want


def test_a_name_leaves_few_customers(tables, index):
    dim = tables.table("dim_customer")
    few = search_index.candidates(index, "wijaya")
    assert 0 < few.count() < 0.2 * dim.count()
    assert search_index.candidates(index, "an") is None and search_index.candidates(index, "a%b") is None


def test_only_the_postings_of_the_term_are_read(tables, index):
    plan = search_index.candidates(index, "wijaya")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [bucket#" in scan and "In(piece, [aya,ija,jay,wij])" in scan
    looked_up = search_index.reduced(tables.table("dim_customer"), index, "wijaya")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in looked_up and "In(resolved_customer_id" in looked_up


def test_many_candidates_are_joined(tables, index, monkeypatch):
    monkeypatch.setattr(search_index, "LOOKED_UP", 0)
    plan = search_index.reduced(tables.table("dim_customer"), index, "wijaya")._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


def test_odd_texts(spark):
    rows = [("rc_1", None, [], ["+62"]), ("rc_2", "ÀÉÎ ñ", ["x@y.z"], None), ("rc_3", "ab", None, [])]
    dim = spark.createDataFrame(rows, "resolved_customer_id string, name_std string, emails array<string>, phones array<string>")
    found = {(r["piece"], r["resolved_customer_id"]) for r in search_index.postings(dim).collect()}
    assert {("+62", "rc_1"), ("àéî", "rc_2"), ("x@y", "rc_2")} <= found
    assert all(len(p) == 3 and p == p.lower() for p, _ in found)
    assert search_index.postings(dim.limit(0)).count() == 0


def test_postings_are_shuffled_once(spark):
    rows = [(1, "Ana Ana", ["ana@x.id"], ["628"]), (1, "Ana", None, None), (None, "Ana", [], [None, "62"])]
    dim = spark.createDataFrame(rows, "resolved_customer_id long, name_std string, emails array<string>, phones array<string>")
    found = search_index.postings(dim)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    got = [(r["piece"], r["resolved_customer_id"]) for r in found.collect()]
    assert len(got) == len(set(got)) and {("ana", 1), ("628", 1), ("ana", None)} <= set(got) and ("62", None) not in got

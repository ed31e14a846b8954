"""Figures kept by change propagation equal figures made from all rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tripweave.plans import kept
from tripweave.plans.kept import Figures, KeptFigures
from tripweave.sources.files import path_exists
from tripweave.sources.tables import MonthlyTable, SnapshotTable
from test_daily import AS_OF, DAYS, content, job_with_landed_days
from tripweave.plans.daily import DailyJob

SHAPE = "id string, k string, at timestamp, v bigint"
FIGURES = Figures(("k",), lambda: {"total": F.col("v")}, lambda: {"first": F.col("at")}, lambda: {"last": F.col("at")})


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, k string, at string, v bigint").withColumn("at", F.col("at").cast("timestamp"))


def kept_table(spark, path):
    return KeptFigures(FIGURES, SnapshotTable(spark, f"{path}/kept")), MonthlyTable(spark, f"{path}/rows", "id", "at", frame(spark, []).schema, 4)


def apply(spark, path, state, table, batch):
    seen = []
    months = table.upsert(batch, watch=lambda rows: seen.append(SnapshotTable(spark, f"{path}/before").write(FIGURES.of(rows))))
    if not seen:
        return state.rebuild(table.read())
    return state.update([seen[0]], [table.read(months)], table.read())


@pytest.mark.parametrize("seed", [1])
def test_random_changes_equal_a_rebuild(spark, tmp_path, seed):
    """Inserts, replaced amounts, moves between months and keys, missing keys and times."""
    pick = random.Random(seed)
    state, table = kept_table(spark, tmp_path)
    for turn in range(4):
        rows = {}
        for _ in range(25):
            at = pick.choice([None, *[f"2026-{m:02d}-{d:02d} 10:00:00" for m in (1, 2, 3, 4) for d in (1, 9)]])
            i = pick.choice([f"b{pick.randrange(40)}", f"b{pick.randrange(40)}", None])
            rows[i or (turn, len(rows))] = (i, pick.choice(["x", "y", "z", None, f"k{pick.randrange(9)}"]), at, pick.choice([None, 1, 5]))
        now = apply(spark, tmp_path, state, table, frame(spark, list(rows.values())))
        assert content(now) == content(FIGURES.of(table.read())) == content(state.read())


def test_only_keys_that_lost_their_bound_are_looked_up(spark, tmp_path):
    state, table = kept_table(spark, tmp_path)
    apply(spark, tmp_path, state, table, frame(spark, [("1", "a", "2026-01-01", 1), ("2", "a", "2026-03-01", 1), ("3", "b", "2026-03-02", 1), ("4", "c", "2026-03-05", 1)]))
    before = FIGURES.of(table.read(["2026-03"]))
    # a loses its latest row, b keeps it with another amount, c is untouched.
    changed = frame(spark, [("3", "b", "2026-03-02", 9), ("4", "c", "2026-03-05", 1)])
    out = {r["k"]: r for r in FIGURES.merged(state.read(), [before], [FIGURES.of(changed)]).collect()}
    assert {k: r["_stale"] for k, r in out.items()} == {"a": True, "b": False, "c": False}
    assert (out["b"]["total"], out["c"]["total"], out["a"]["total"]) == (9, 1, 1)


def test_a_key_without_rows_goes(spark, tmp_path):
    state, table = kept_table(spark, tmp_path)
    apply(spark, tmp_path, state, table, frame(spark, [("1", "a", "2026-01-01", 1), ("2", "b", "2026-01-01", 2)]))
    now = apply(spark, tmp_path, state, table, frame(spark, [("1", "b", "2026-01-01", 1)]))
    assert [(r["k"], r["total"], r["_rows"]) for r in now.collect()] == [("b", 3, 2)]


def test_untouched_months_are_not_read_for_inserts(spark, tmp_path):
    plan = FIGURES.merged(FIGURES.of(frame(spark, [])), [], [FIGURES.of(frame(spark, []))])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_booking_figures_equal_the_aggregate(spark, tables):
    from tripweave.plans import marts

    fact = tables.table("fact_bookings")
    assert content(marts.kept_booking_figures(kept.BOOKINGS.of(fact))) == content(marts.bookings_agg(fact))


def test_contacts_give_the_links_of_the_tickets(spark, tables):
    from tripweave.plans import identity

    tickets, anchors = tables.table("silver_tickets"), tables.anchors()
    links = identity.contact_links(kept.CONTACTS.of(tickets), anchors).filter("link is not null")
    want = identity.ticket_links(tickets, anchors).filter("link is not null")
    columns = ["link", "link_value", "first_seen", "last_seen", "tickets", "named", "timed", "confidence_rank"]
    assert content(links.select(columns)) == content(want.select(columns))


def test_a_lost_run_makes_the_figures_anew(spark, tables, tmp_path, monkeypatch):
    """A run that dies after the tables changed, before the figures did, is made good by the next one."""
    whole = job_with_landed_days(spark, tables, str(tmp_path / "whole"))
    want = {n: content(df) for n, df in whole.run(DAYS).items() if n in ("mart_customer_clv", "dim_customer")}
    job = job_with_landed_days(spark, tables, str(tmp_path / "lost"))
    job.run(DAYS[:2])

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(DailyJob, "_update_fact", die)
        with pytest.raises(RuntimeError):
            job.run(DAYS[2:])
    assert path_exists(spark, job._unfinished)
    again = DailyJob(spark, job.root, AS_OF).run(DAYS[2:])
    assert {n: content(again[n]) for n in want} == want
    assert not path_exists(spark, job._unfinished)

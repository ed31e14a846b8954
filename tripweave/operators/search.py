"""Customer search: optional conditions and the sort switch, as column predicates."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripweave.functions.identity import hex_id

OMNICHANNEL_SYSTEMS = 3


@dataclass(frozen=True)
class SearchFilter:
    """Conditions are combined with AND; an empty or missing one does not restrict."""

    term: str = ""
    tiers: tuple[str, ...] = ()
    churn_range: tuple[float | None, float | None] = (None, None)
    actions: tuple[str, ...] = ()
    has_ticket: bool = False
    type_range: tuple[int | None, int | None] = (None, None)
    omnichannel: bool = False

    def on_figures(self) -> Column:
        """The conditions over columns of the value mart."""
        wanted = {"loyalty_tier": self.tiers, "recommended_action": self.actions}
        ranges = {"churn_risk_score": self.churn_range, "distinct_booking_types": self.type_range}
        parts = [F.col(name).isin(list(values)) for name, values in wanted.items() if values]
        for name, (low, high) in ranges.items():
            parts += [F.col(name) >= low] if low is not None else []
            parts += [F.col(name) <= high] if high is not None else []
        return _all(parts + ([F.col("has_support_ticket") == 1] if self.has_ticket else []))

    def asks_identity(self) -> bool:
        """Whether any condition is about the customer table."""
        return bool(self.term) or self.omnichannel

    def on_identity(self) -> Column:
        """The conditions over columns of the customer table."""
        term = [matches_term(self.term)] if self.term else []
        return _all(term + ([F.size("source_systems") == OMNICHANNEL_SYSTEMS] if self.omnichannel else []))


def _all(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def matches_term(term: str) -> Column:
    """Name by pattern (``%`` and ``_`` are live, a backslash is itself), email, phone and hex id by plain text."""
    low = term.lower()
    pattern = term.replace("\\", "\\\\")

    def holds(c: Column) -> Column:
        return F.contains(F.lower(c), F.lit(low))

    name = F.coalesce(F.col("name_std").ilike(f"%{pattern}%"), F.lit(False))
    return (
        name
        | F.exists("emails", holds)
        | F.exists("phones", holds)
        | holds(hex_id(F.col("resolved_customer_id")))
    )


_SORT_COLUMNS = {
    "clv_desc": "clv_idr",
    "churn_risk_desc": "churn_risk_score",
    "dormant_desc": "dormant_days",
    "last_booking_desc": "last_booking_ts",
}


def sort_order(sort_by: str) -> list[Column]:
    """Descending by the chosen figure, NULLs last, ties by id; unknown names sort by value."""
    column = _SORT_COLUMNS.get(sort_by, _SORT_COLUMNS["clv_desc"])
    return [F.col(column).desc_nulls_last(), F.col("resolved_customer_id").asc()]

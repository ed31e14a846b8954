"""Customer ids and source-scoped ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_PREFIX = "72635F"  # the text 'rc_' in hexadecimal


def resolved_id(email: Column) -> Column:
    """Customer id of an email: ``rc_`` and the first 12 bytes of its MD5, as 24 hex digits."""
    return F.concat(F.lit("rc_"), F.substring(F.md5(F.lower(F.trim(email))), 1, 24))


def hex_id(resolved: Column) -> Column:
    return F.upper(F.concat(F.lit(_HEX_PREFIX), F.substring(resolved, 4, 24)))


def id_from_hex(hex_text: str) -> str | None:
    """The stored id behind a 30-character hex id, so that lookups compare the raw key column."""
    text = hex_text.upper()
    if len(text) != 30 or not text.startswith(_HEX_PREFIX):
        return None
    return "rc_" + text[len(_HEX_PREFIX):].lower()


def scoped(source: str, c: Column) -> Column:
    return F.concat(F.lit(f"{source}:"), c)


def placeholder_id(scoped_id: Column) -> Column:
    """Stable id for a booking source key that no customer claims yet."""
    return F.concat(F.lit("ph_"), F.substring(F.md5(scoped_id), 1, 24))

"""Text forms of amounts and phone numbers for exports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idr(c: Column) -> Column:
    """``Rp 98.820.000``; the sign follows the currency, NULL and zero read ``Rp 0``."""
    grouped = F.replace(F.format_number(F.abs(c), 0), F.lit(","), F.lit("."))
    sign = F.when(c < 0, "-").otherwise("")
    return F.when(c != 0, F.concat(F.lit("Rp "), sign, grouped)).otherwise("Rp 0")


def phone(c: Column) -> Column:
    """``+62 817-2599-6882`` for complete Indonesian numbers, anything else as it is."""
    e164 = F.trim(c)
    spaced = F.concat(
        F.substring(e164, 1, 3), F.lit(" "), F.substring(e164, 4, 3), F.lit("-"),
        F.substring(e164, 7, 4), F.lit("-"), F.substr(e164, F.lit(11)),
    )
    complete = e164.startswith("+62") & (F.length(e164) >= 12)
    return F.when(complete, spaced).otherwise(F.coalesce(e164, F.lit("")))


def phone_masked(c: Column) -> Column:
    masked = F.concat(F.lit("+62..."), F.right(c, F.lit(4)))
    return F.when(F.length(c) >= 8, masked).otherwise(F.coalesce(c, F.lit("")))

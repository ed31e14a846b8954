"""Cleansing expressions for contact data, names, amounts and coded fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------------
PHONE_SENTINELS = ["TIDAK ADA", "tidak diketahui", "000-000-0000", "", "0"]
EXTRA_SENTINELS = ["N/A", "unknown", "-1"]
MAIL_DOMAIN_FIXES = [("gnail", "gmail"), ("gmaill", "gmail"), ("yaho", "yahoo")]
TITLES = ["bpk.", "ibu", "sdr.", "h.", "drs.", "dr.", "drg.", "ir.", "tgk.", "dt.", "r.", "r.a."]
BACHELOR_DEGREES = ["kom", "ip", "farm", "ked", "sos", "psi", "h", "e"]
MASTER_DEGREES = ["kom", "m", "t"]
MOJIBAKE = "ÂâÃãÄäÅå"
BANK_TRANSFERS = {
    "bank transfer bca": "Bank Transfer (BCA)",
    "bank transfer mandiri": "Bank Transfer (Mandiri)",
    "bank transfer bri": "Bank Transfer (BRI)",
    "bank transfer bni": "Bank Transfer (BNI)",
}
STATUS_WORDS = {"batal": "cancelled", "selesai": "completed", "tidak_hadir": "no_show"}
DEFAULT_TIER = "basic"
# -------------------------------------------------------------------------------------------


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def lower_code(c: Column) -> Column:
    return F.lower(F.trim(c))


def upper_code(c: Column) -> Column:
    return F.upper(F.trim(c))


def title_case(c: Column) -> Column:
    """First letter of every space-separated word upper, the rest lower; inner double spaces stay."""
    return F.trim(F.initcap(F.trim(c)))


def _first(c: Column, pattern: str, replacement: str) -> Column:
    # regexp_replace replaces every match; letting the first one swallow the rest leaves no other.
    return F.regexp_replace(c, rf"(?s){pattern}(.*)$", rf"{replacement}$1")


def email(c: Column) -> Column:
    """Lower-cased address without +tag and with the known domain typos repaired; blank becomes NULL."""
    out = _first(F.lower(F.trim(c)), r"\+[^@]*@", "@")
    for wrong, right in MAIL_DOMAIN_FIXES:
        out = _first(out, rf"@{wrong}\.", f"@{right}.")
    return F.when(F.trim(c) != "", out)


def phone(c: Column, extra_sentinels: bool = False) -> Column:
    """Indonesian numbers as +62…; sentinels and short unprefixed numbers become NULL.

    Each step feeds the next once, so no regular expression runs twice per row.
    """
    sentinels = PHONE_SENTINELS + (EXTRA_SENTINELS if extra_sentinels else [])
    digits = F.regexp_replace(F.when(~c.isin(sentinels), c), r"[^0-9]", "")
    prefixed = F.regexp_replace(digits, r"^(?:62|0)(.*)$|^(.{10,})$", "+62$1$2")
    return F.nullif(F.regexp_replace(prefixed, r"^[0-9]+$", ""), F.lit(""))


def whole_hundreds(c: Column) -> Column:
    """A whole amount rounded half-even to the nearest 100; zero counts as unknown."""
    return F.when(c != 0, (F.bround(c / F.lit(100.0)) * 100).cast("bigint"))


def amount_text(c: Column) -> Column:
    """The same rule for amounts delivered as text, e.g. ``Rp 9.999,50``."""
    trimmed = F.trim(c)
    bare = F.trim(F.when(trimmed.startswith("Rp"), F.substr(trimmed, F.lit(3))).otherwise(c))
    plain = F.regexp_replace(F.replace(bare, F.lit("."), F.lit("")), r"(?s),.*$", "")
    return whole_hundreds(F.when(plain.rlike(r"^[+-]?[0-9]+$"), plain.try_cast("bigint")))


def _either(words: list[str]) -> str:
    return "|".join(w.replace(".", r"\.") for w in words)


def person_name(c: Column, extra_sentinels: bool = False) -> Column:
    """Name without a leading title or trailing degree, in title case; blank becomes NULL."""
    untitled = F.regexp_replace(F.lower(F.trim(c)), rf"^({_either(TITLES)})\s+", "")
    degree = rf",\s*(s\.({_either(BACHELOR_DEGREES)})\.|m\.({_either(MASTER_DEGREES)})\.)\s*$"
    out = F.when(F.trim(c) != "", title_case(F.regexp_replace(untitled, degree, "")))
    return F.when(~F.trim(c).isin(EXTRA_SENTINELS), out) if extra_sentinels else out


def postal_code(c: Column) -> Column:
    return F.substring(F.trim(c), 1, 5)


def tier_or_default(c: Column) -> Column:
    return F.coalesce(F.nullif(lower_code(c), F.lit("")), F.lit(DEFAULT_TIER))


def _translated(words: dict[str, str], word: Column) -> Column:
    pairs = [F.lit(text) for pair in words.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), word)


def payment_method(c: Column, strict: bool = True) -> Column:
    """Canonical spelling of the four bank transfers, title case for the rest.

    With ``strict=False`` an already parenthesised bank (``Bank Transfer (BCA)``) is recognised too.
    """
    word = lower_code(c)
    if not strict:
        word = F.regexp_replace(word, r"^bank transfer \((\w+)\)$", "bank transfer $1")
    return F.coalesce(_translated(BANK_TRANSFERS, word), title_case(c))


def booking_status(c: Column) -> Column:
    word = lower_code(c)
    return F.coalesce(_translated(STATUS_WORDS, word), word)


def guests(c: Column) -> Column:
    return F.coalesce(c, F.lit(1).cast("bigint"))


def participants(c: Column) -> Column:
    return F.when(c != 0, c).otherwise(F.lit(1).cast("bigint"))


def without_mojibake(c: Column) -> Column:
    return F.trim(F.translate(c, MOJIBAKE, ""))

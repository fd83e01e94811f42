"""Parsing and normalising of single values, as columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no value", truth and falsehood, and how markets are coded.
NULL_TOKENS = ("", "none", "null", "nan", "n/a", "na", "-")
PLACEHOLDERS = ("n/a", "na", "none", "null", "tbd", "unknown", "unspecified", "not available", "not provided", "-")
TRUTHS = ("1", "true", "t", "yes", "y", "on")
FALSEHOODS = ("0", "false", "f", "no", "n", "off")
MARKET_CODES = {
    "NASDAQ": "XNAS", "NASDAQ GLOBAL MARKET": "XNAS", "NASDAQ CAPITAL MARKET": "XNAS", "NASDAQ GLOBAL SELECT": "XNAS",
    "NYSE": "XNYS", "NEW YORK STOCK EXCHANGE": "XNYS", "NYSE MKT": "XASE", "NYSE AMERICAN": "XASE", "AMEX": "XASE",
    "ARCA": "ARCX", "NYSE ARCA": "ARCX", "BATS": "BATS", "CBOE BZX": "BATS",
    "OTC": "OTCM", "OTCQX": "OTCM", "OTCQB": "OTCM", "PINK": "OTCM",
}
SCALES = {"K": 1e3, "M": 1e6, "B": 1e9, "T": 1e12}


def snake_case(x: Column) -> Column:
    """Camel humps, the last of several capitals that a word begins with, and anything but letters and digits become single underscores; lower case.

    What is empty then is ``col``.
    """
    x = F.regexp_replace(F.trim(x), r"(.)([A-Z][a-z]+)", "$1_$2")
    x = F.regexp_replace(x, r"([a-z0-9])([A-Z])", "$1_$2")
    x = F.lower(F.regexp_replace(F.regexp_replace(x, r"[^0-9A-Za-z]+", "_"), r"^_+|_+$|(?<=_)_+", ""))
    return F.when(x == "", "col").otherwise(x)


def number(x: Column) -> Column:
    """A double, or null for the tokens that mean none and for what is no number."""
    t = F.lower(F.trim(x))
    return F.when(~t.isin(*NULL_TOKENS), F.replace(t, F.lit(","), F.lit("")).try_cast("double"))


def human_number(x: Column) -> Column:
    """``1.2B``, ``(3)`` as -3, ``5%`` as 5, thousands separators."""
    t = F.upper(F.trim(x))
    negative = t.startswith("(") & t.endswith(")")
    bare = F.regexp_replace(t, r"[(),$%\s]", "")
    unit = F.regexp_extract(bare, r"([KMBT])$", 1)
    base = F.regexp_replace(bare, r"[KMBT]$", "").try_cast("double")
    scale = F.lit(1.0)
    for k, v in SCALES.items():
        scale = F.when(unit == k, v).otherwise(scale)
    return F.when(negative, -base * scale).otherwise(base * scale)


def half_up(x: Column, places: int) -> Column:
    return F.round(x, places)


def flexible_time(x: Column) -> Column:
    """Epoch seconds or milliseconds by size, or ISO text."""
    n = x.try_cast("double")
    return F.when(F.abs(n) >= 1e10, F.timestamp_millis(n.cast("long"))).when(F.abs(n) >= 1e9, F.timestamp_seconds(n)).otherwise(
        F.try_to_timestamp(x))


def range_middle(x: Column) -> Column:
    """``$1,001 - $15,000`` as 8000.5; a single amount is itself."""
    bare = F.regexp_replace(x, r"[$,\s]", "")
    low, high = F.regexp_extract(bare, r"^(\d+(?:\.\d+)?)", 1).try_cast("double"), F.regexp_extract(bare, r"-(\d+(?:\.\d+)?)$", 1).try_cast("double")
    return F.coalesce((low + high) / 2, low)


def clean_key(x: Column) -> Column:
    return snake_case(F.replace(F.replace(x, F.lit("%"), F.lit("pct")), F.lit("$"), F.lit("usd")))


def truth(x: Column) -> Column:
    t = F.lower(F.trim(x))
    return F.when(t.isin(*TRUTHS), True).when(t.isin(*FALSEHOODS), False)


def stripped_markup(x: Column) -> Column:
    t = F.regexp_replace(x, r"<[^>]+>", " ")
    t = F.replace(F.replace(t, F.lit("&nbsp;"), F.lit(" ")), F.lit("&amp;"), F.lit("&"))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def listed(x: Column) -> Column:
    """A JSON list of texts, or values between commas."""
    plain = F.filter(F.transform(F.split(x, ","), lambda v: F.trim(v)), lambda v: v != "")
    return F.when(F.trim(x).startswith("["), F.from_json(x, "array<string>")).otherwise(plain)


def real_text(x: Column) -> Column:
    """Null for blanks and placeholders."""
    t = F.trim(x)
    return F.when((t != "") & ~F.lower(t).isin(*PLACEHOLDERS), t)


def single_spaced(x: Column) -> Column:
    """Single spaces, none at the ends; empty if nothing is left."""
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def squeezed(x: Column) -> Column:
    """Single spaces, none at the ends; null if nothing is left."""
    return F.nullif(single_spaced(x), F.lit(""))


def bound(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def market_code(x: Column) -> Column:
    """The market's code by the exchange's name; null for names that are not listed."""
    return F.element_at(F.create_map(*[F.lit(v) for kv in MARKET_CODES.items() for v in kv]), F.upper(squeezed(x)))


def share_class(name: Column, symbol: Column) -> Column:
    """``Class B`` by the name, else by the letter behind the symbol's dot or dash."""
    named = F.nullif(F.upper(F.regexp_extract(name, r"(?i)\bclass\s+([a-z0-9]+)\b", 1)), F.lit(""))
    return F.concat(F.lit("Class "), F.coalesce(named, F.nullif(F.regexp_extract(F.upper(symbol), r"[.\-]([A-Z])$", 1), F.lit(""))))


def periods_per_year(bar: Column) -> Column:
    """``5m``, ``1h``, ``1d``, ``1w``, ``1mo`` as bars a year of 252 days of 6.5 hours."""
    n = F.regexp_extract(F.lower(bar), r"^(\d+)", 1).try_cast("double")
    unit = F.regexp_extract(F.lower(bar), r"([a-z]+)$", 1)
    return F.when(unit == "m", 252 * 390 / n).when(unit == "h", 252 * 6.5 / n).when(unit == "d", 252 / n).when(unit == "w", 52 / n).when(unit == "mo", 12 / n)


def stable_hash(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]), 256)


def band_state(x: Column, width: float, names: tuple[str, str, str]) -> Column:
    """Below, within or above a band around zero."""
    return F.when(x < -width, names[0]).when(x > width, names[2]).when(x.isNotNull(), names[1])

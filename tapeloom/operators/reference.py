"""Reference data of symbols: what texts of providers tell, filled into profiles that lack it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.scalars import PLACEHOLDERS, market_code, share_class, squeezed

# Listing states by the first of these words that a status holds as a whole word (so what is inactive is not active), words of flags, and kinds of security by words of the asset type, in order.
LISTING_STATES = {
    "active": "active", "listed": "active", "trading": "active", "tradable": "active", "delisted": "delisted", "inactive": "inactive",
    "suspended": "suspended", "halted": "suspended", "bankrupt": "bankrupt", "acquired": "acquired", "merged": "acquired",
}
FLAG_WORDS = {
    "is_etf": (" etf", "exchange traded fund", "exchange-traded fund", "index fund"), "is_cef": ("closed-end", "closed end", "cef"),
    "is_preferred": ("preferred", "preference share", "preference stock"), "is_adr": (" adr", "american depositary", "depositary receipt"),
}
FLAG_KINDS = {"is_etf": "etf", "is_cef": "closed_end_fund", "is_preferred": "preferred", "is_adr": "adr"}
ASSET_KINDS = {
    "etf": "etf", "fund": "etf", "preferred": "preferred", "adr": "adr", "depositary": "adr", "unit": "unit", "warrant": "warrant",
    "stock": "common_equity", "equity": "common_equity", "common": "common_equity",
}
FACT_COLUMNS = ("symbol", "name", "description", "asset_type", "exchange", "sector", "industry", "industry2")
FIELDS = ("exchange_mic", "country_of_risk", "listing_status_norm", "share_class", "security_type_norm", *FLAG_WORDS)


def _first_word(text: Column, words: dict[str, str], whole: bool = False) -> Column:
    out = F.lit(None).cast("string")
    for word, value in reversed(words.items()):
        out = F.when(text.rlike(rf"\b{word}\b") if whole else text.contains(word), value).otherwise(out)
    return out


def inferred() -> dict[str, Column]:
    """Every field that columns of facts (FACT_COLUMNS, country, status, delisting_date) tell; null where they do not. Flags are ``true`` or null."""
    corpus = F.concat_ws(" ", *[F.lower(F.trim(c)) for c in FACT_COLUMNS])
    flags = {}
    for name, words in FLAG_WORDS.items():
        hit = F.lit(False)
        for w in words:
            hit = hit | corpus.contains(w)
        flags[name] = F.when(hit, "true")
    kind = _first_word(F.lower(squeezed(F.col("asset_type"))), ASSET_KINDS)
    for name, value in reversed(FLAG_KINDS.items()):
        kind = F.when(flags[name].isNotNull(), value).otherwise(kind)
    status = F.when(F.trim("delisting_date") != "", "delisted").otherwise(_first_word(F.lower(squeezed(F.col("status"))), LISTING_STATES, True))
    return {
        "exchange_mic": market_code(F.col("exchange")), "country_of_risk": squeezed(F.col("country")), "listing_status_norm": status,
        "share_class": share_class(F.coalesce("name", F.lit("")), F.col("symbol")), "security_type_norm": kind, **flags,
    }


def missing(x: Column) -> Column:
    """Null, blank, or a placeholder."""
    return squeezed(x).isNull() | F.lower(squeezed(x)).isin(*[p for p in PLACEHOLDERS if p != "-"])


def clean_symbols(facts: DataFrame, profiles: DataFrame, locked: str = "locked_fields", mode: str = "fill_missing") -> DataFrame:
    """``symbol``, a struct ``updates`` with the new value of every field that changes, and ``remaining``.

    ``profiles`` has the fields as texts and an array of ``locked`` names, which
    are left alone. ``fill_missing`` asks only for missing fields, ``full`` for
    all. Fields that were asked for and that no fact tells are ``remaining``.
    Symbols without a profile lack everything.
    """
    told = facts.select("symbol", F.struct(*[c.alias(n) for n, c in inferred().items()]).alias("_told"))
    j = told.join(profiles.select("symbol", locked, F.struct(*FIELDS).alias("_has")), "symbol", "left")
    names = F.coalesce(locked, F.array().cast("array<string>"))
    asked = {n: ~F.array_contains(names, n) & (missing(F.col("_has")[n]) if mode == "fill_missing" else F.lit(True)) for n in FIELDS}
    updates = F.struct(*[F.when(asked[n] & ~F.col("_told")[n].eqNullSafe(F.col("_has")[n]), F.col("_told")[n]).alias(n) for n in FIELDS])
    open_ = F.array_compact(F.array(*[F.when(asked[n] & F.col("_told")[n].isNull(), F.lit(n)) for n in FIELDS]))
    return j.select("symbol", updates.alias("updates"), open_.alias("remaining"))

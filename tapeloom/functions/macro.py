"""What a macro event or headline is about, from its text and source, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeloom.functions.scalars import bound

# Words of event groups in order, what makes an event important, places by source and by text, and factors by group.
EVENT_WORDS = {
    "Labor": ("nonfarm payroll", "employment situation", "jobless", "unemployment", "labor"),
    "Inflation": ("consumer price", "cpi", "ppi", "pce", "inflation"),
    "GrowthActivity": ("gdp", "gross domestic product", "retail sales", "industrial production", "pmi", "ism"),
    "Housing": ("housing", "building permits", "home sales", "case-shiller"),
    "ConsumerSentiment": ("sentiment", "confidence"),
    "TradeExternal": ("trade", "imports", "exports", "current account"),
    "RatesFiscal": ("treasury auction", "auction", "yield", "federal funds"),
    "CentralBankPolicy": ("fomc", "monetary policy", "bank rate", "governing council", "statement on monetary policy", "minutes"),
    "CreditRegulatory": ("credit", "loan", "regulatory", "supervision"),
}
OTHER_GROUP = "GrowthActivity"
HIGH_WORDS = ("cpi", "nonfarm payroll", "employment situation", "gdp", "pce")
HIGH_GROUPS, MEDIUM_GROUPS = ("Inflation", "Labor"), ("GrowthActivity", "RatesFiscal")
POLICY_NOTES = ("minutes", "account")
US, EA, GB, JP = ("US", "North America", "USD"), ("EA", "Europe", "EUR"), ("GB", "Europe", "GBP"), ("JP", "Asia", "JPY")
SOURCE_PLACES = {
    "fred_releases": US, "bls_release_calendar": US, "bea_release_schedule": US, "fomc_schedule": US, "treasury_auction_schedule": US,
    "ecb_policy_calendar": EA, "boe_mpc_calendar": GB, "boj_release_schedule": JP,
}
TEXT_PLACES = (
    (("euro", "ecb"), EA), (("bank of england", "uk ", "britain"), GB), (("bank of japan", "japan", "boj"), JP), (("fed", "fomc", "u.s.", "us "), US),
)
FACTORS = {
    "Inflation": ("inflation",), "Labor": ("labor",), "GrowthActivity": ("growth",), "RatesFiscal": ("rates",), "CentralBankPolicy": ("policy", "rates"), "CreditRegulatory": ("credit",),
}


def _plain(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(F.regexp_replace(text, r"[\s ]+", " "))), F.lit(""))


def _has(text: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def event_group(text: Column) -> Column:
    """The first group one of whose words the text holds."""

    def told(t: Column) -> Column:
        out = F.lit(OTHER_GROUP)
        for group, words in reversed(EVENT_WORDS.items()):
            out = F.when(_has(t, words), group).otherwise(out)
        return out

    return bound(_plain(text), told)


def importance(text: Column, group: Column) -> Column:
    def told(t: Column) -> Column:
        policy = F.when(_has(t, POLICY_NOTES), "medium").otherwise("high")
        high = _has(t, HIGH_WORDS) | group.isin(*HIGH_GROUPS)
        return F.when(group == "CentralBankPolicy", policy).when(high, "high").when(group.isin(*MEDIUM_GROUPS), "medium").otherwise("low")

    return bound(_plain(text), told)


def place(source: Column, text: Column) -> Column:
    """Country, region and currency by the source, else by the text; null if neither tells."""

    def told(x: tuple[str, str, str]) -> Column:
        return F.struct(*[F.lit(v).alias(n) for v, n in zip(x, ("country", "region", "currency"), strict=True)])

    def by_text(t: Column) -> Column:
        out = F.lit(None)
        for words, where in reversed(TEXT_PLACES):
            out = F.when(_has(t, words), told(where)).otherwise(out)
        return out

    out = bound(_plain(text), by_text)
    for name, where in SOURCE_PLACES.items():
        out = F.when(source == name, told(where)).otherwise(out)
    return out


def factor_tags(group: Column) -> Column:
    tags = F.create_map(*[x for g, names in FACTORS.items() for x in (F.lit(g), F.array(*map(F.lit, names)))])
    return F.coalesce(F.element_at(tags, group), F.array().cast("array<string>"))


def event_key(country: Column, group: Column, kind: Column, period: Column, at: Column, source_key: Column) -> Column:
    """One key for an event that several sources report: place, group, kind, period and time (its source's key without a time)."""
    moment = F.coalesce(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.trim(source_key), F.lit(""))
    return F.sha2(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in (country, group, kind, period)], moment), 256)


def headline_key(url: Column, headline: Column, at: Column, author: Column) -> Column:
    """One key for a headline: its address, or else its text, with time and author."""
    anchor = F.coalesce(F.nullif(F.trim(url), F.lit("")), F.trim(headline), F.lit(""))
    return F.sha2(F.concat_ws("|", anchor, F.coalesce(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("")), F.coalesce(author, F.lit(""))), 256)

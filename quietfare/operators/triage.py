"""Classification of free-text data requests by literal keywords, as Column expressions. Decisions on requests are left to their owner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keywords of the privacy tiers, in the order of their check.
FIELD_KEYWORDS = {
    "direct": ["name", "license", "plate", "vin", "phone", "telephone", "email", "payment", "card", "device", "rider id", "driver id", "ssn", "address", "identity", "identities"],
    "sensitive": ["disab", "wheelchair", "wav", "access-a-ride", "access a ride", "paratransit", "accessible", "support note", "note", "free text", "free-text"],
    "quasi": ["pickup", "drop", "location", "zone", "borough", "gps", "coordinate", "datetime", "timestamp", "time", "date", "mile", "distance", "duration"],
    "safe": ["fare", "fee", "tax", "toll", "tip", "count", "number of", "total", "aggregate", "statistic", "surcharge", "amount"],
}
# Keywords of the sharing profiles, in the order of their check.
PROFILE_KEYWORDS = {
    "le": ["investigation", "law enforcement", "police", "subpoena", "warrant", "court order", "suspect", "specific individual", "specific trip", "particular trip", "case number", "criminal"],
    "mds": ["count", "aggregate", "statistic", "total", "number of", "trend", "by zone", "by borough", "per zone", "distribution", "summary", "how many"],
    "tlc": ["trip record", "all trips", "full dataset", "row-level", "row level", "raw trip", "every trip", "complete record", "microdata"],
}


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Whether the text contains one of the words literally; null for null."""
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word)
    return found


def first_class(text: Column, keywords: dict[str, list[str]]) -> Column:
    """The first class with a keyword in the text, in lower case; null if there is none."""
    low = F.lower(text)
    out = F.lit(None).cast("string")
    for name in reversed(keywords):
        out = F.when(contains_any(low, keywords[name]), F.lit(name)).otherwise(out)
    return out


def field_tier(field: Column) -> Column:
    return first_class(field, FIELD_KEYWORDS)


def request_profile(scope: Column, fields: Column) -> Column:
    """The sharing profile a request's words point to. Null parts count as empty."""
    return first_class(F.concat_ws(" ", F.coalesce(scope, F.lit("")), F.array_join(F.coalesce(fields, F.array().cast("array<string>")), " ")), PROFILE_KEYWORDS)

"""Where a record comes from and how far its source is trusted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placebook.functions.text import column

# fixed values: source kinds, most trusted first, with the words that reveal them
SOURCE_KINDS = [
    ("places_api", ["places api"]),
    ("gmaps", ["google maps"]),
    ("osm", ["openstreetmap"]),
    ("directory", ["finelib", "ngex", "cybo", "vconnect", "businesslist", "directory", "nigeriagalleria",
                   "connectnigeria", "legacy seed"]),
    ("manual", ["csv", "manual"]),
]
GOOGLE_KINDS = ["places_api", "gmaps"]
TRUST_LEVELS = range(1, len(SOURCE_KINDS) + 1)


def _ladder(source: Column | str, values: list) -> Column:
    text = F.lower(F.coalesce(column(source), F.lit("")))
    out = None
    for (_, words), value in zip(SOURCE_KINDS, values):
        test = F.lit(False)
        for word in words:
            test = test | F.contains(text, F.lit(word))
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return out.otherwise(F.lit(values[-1]))


def source_kind(source: Column | str) -> Column:
    """Kind of a source text; an unknown one counts as manual."""
    return _ladder(source, [kind for kind, _ in SOURCE_KINDS])


def trust(source: Column | str) -> Column:
    """5 for the most trusted kind down to 1."""
    return _ladder(source, list(reversed(TRUST_LEVELS)))


def is_google(sources_all: Column | str = "sources_all") -> Column:
    return F.exists(column(sources_all), lambda s: source_kind(s).isin(GOOGLE_KINDS))

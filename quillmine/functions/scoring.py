"""Rule scores (O2, F19-F22) and coercion to controlled vocabularies."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import text
from .lexicon import contains_any, hits

MULTI_STRAIN = r"(?i)\b(\d+|two|three|four|five|six|seven|eight|nine|ten)\s+strains?\b"


@dataclass(frozen=True)
class Phrases:
    """Phrase lists that the scores look for."""

    technique: list[str]
    failure: list[str]
    success: list[str]
    title_tools: list[str] = field(default_factory=list)
    generic: list[str] = field(default_factory=list)
    title_methods: list[str] = field(default_factory=list)


def points(condition: Column, n: int) -> Column:
    return F.when(condition, n).otherwise(0)


def shortlist_score(title: Column, routes: Column, organism: list[str], method: list[str], failure: list[str], review: list[str]) -> Column:
    """``routes``: array of discovery routes."""
    return (
        points(contains_any(title, organism), 2) + points(contains_any(title, method), 3) + points(contains_any(title, failure), 2)
        + points(F.array_contains(routes, "negative_keyword"), 3) + points(F.array_contains(routes, "organism_specific"), 2)
        - points(contains_any(title, review), 3)
    )


def abstract_score(title: Column, abstract: Column, phrases: Phrases) -> Column:
    whole = F.concat_ws(" ", text(title), text(abstract))
    return (
        F.least(F.lit(2), F.size(hits(whole, phrases.technique))) * 3 + points(contains_any(whole, phrases.failure), 6) + points(contains_any(whole, phrases.success), 4)
        + points(contains_any(title, phrases.title_tools), 3) + points(contains_any(whole, phrases.generic), 2)
    )


def passage_points(bucket: Column, passage: Column, phrases: Phrases) -> Column:
    """Points of one passage; only the three scored buckets get any."""
    technique = F.when(bucket == "SUPPLEMENT", 3).otherwise(5)
    earned = F.when(contains_any(passage, phrases.technique), technique).otherwise(0) + points(contains_any(passage, phrases.failure), 6) + points(contains_any(passage, phrases.success), 4)
    return F.when(bucket.isin("METHODS", "RESULTS", "SUPPLEMENT"), earned).otherwise(0)


def coerce(col: Column, allowed: list[str], fallback: str) -> Column:
    return F.when(col.isin(*allowed), col).otherwise(F.lit(fallback))


def flags(**wrong: Column) -> Column:
    """Space-joined names of the conditions that hold, in the order given."""
    return F.concat_ws(" ", *(F.when(F.coalesce(c, F.lit(True)), F.lit(name)) for name, c in wrong.items()))


def bucket_of(section_type: Column, buckets: dict[str, str], default: str = "OTHER") -> Column:
    """Bucket of a raw section type."""
    out = F.lit(default)
    for raw, bucket in buckets.items():
        out = F.when(F.upper(text(section_type)) == raw, F.lit(bucket)).otherwise(out)
    return out

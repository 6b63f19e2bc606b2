"""Tagging with a lexicon (F13-F15, F18, F24): case-folded substrings, or whole words if asked for.

A lexicon is a dict of category to terms, small configuration that is put into the plan as literals. A ``*`` at a term's
end marks a stem; as terms match inside words anyway it changes nothing in substring mode.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import text

Lexicon = dict[str, list[str]]


def hits(col: Column, terms: list[str], words: bool = False) -> Column:
    """The terms that ``col`` contains, in the order given."""
    low = F.lower(text(col))

    def there(term: str) -> Column:
        bare = term.lower().rstrip("*")
        if not words:
            return F.contains(low, F.lit(bare))
        return low.rlike(rf"(?U)(?<!\w){re.escape(bare)}" + ("" if term.endswith("*") else r"(?!\w)"))

    return F.array_compact(F.array(*(F.when(there(t), F.lit(t)) for t in terms))) if terms else F.array().cast("array<string>")


def contains_any(col: Column, terms: list[str]) -> Column:
    low, out = F.lower(text(col)), F.lit(False)
    for term in terms:
        out = out | F.contains(low, F.lit(term.lower()))
    return out


def tag(col: Column, lexicon: Lexicon, words: bool = False) -> Column:
    """Map of category to matched terms; categories without a hit are left out."""
    entries = F.array(*(F.struct(F.lit(c).alias("key"), hits(col, terms, words).alias("value")) for c, terms in lexicon.items()))
    return F.map_from_entries(F.filter(entries, lambda e: F.size(e["value"]) > 0))


def first_category(col: Column, lexicon: Lexicon, default: str = "other") -> Column:
    """The first category, in the lexicon's order, of which ``col`` contains a term."""
    out = F.lit(default)
    for category, terms in reversed(lexicon.items()):
        out = F.when(contains_any(col, terms), F.lit(category)).otherwise(out)
    return out


def any_of(terms: list[str], within: str = "") -> str:
    """Search query: phrases with a blank are quoted, joined by OR in brackets, and ANDed with ``within``."""
    group = "(" + " OR ".join(f'"{t}"' if " " in t else t for t in terms) + ")"
    return f'"{within}" AND {group}' if within else group

"""Identifiers and their normal forms (F1-F5, F16-F17, F23, F26-F29, F39-F42), as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as blank: Unicode white space and the four ASCII separators.
BLANK = r"(?U)[\s\x1c-\x1f]"


def text(col: Column) -> Column:
    """Missing values are empty strings."""
    return F.coalesce(col.cast("string"), F.lit(""))


def strip(col: Column) -> Column:
    return F.regexp_replace(col, rf"^{BLANK}+|{BLANK.removeprefix('(?U)')}+$", "")


def collapse(col: Column) -> Column:
    """Runs of blanks become one space, none at the ends."""
    return F.trim(F.regexp_replace(col, BLANK + "+", " "))


def normalize_title(title: Column) -> Column:
    low = F.regexp_replace(F.lower(text(title)), "<[^>]+>", " ")
    return F.trim(F.regexp_replace(low, "[^a-z0-9]+", " "))


def normalize_doi(doi: Column) -> Column:
    bare = F.regexp_replace(F.lower(strip(text(doi))), r"^https://doi\.org/", "")
    return F.regexp_replace(bare, "^doi:", "")


def paper_id(doi: Column, pmid: Column, title: Column) -> Column:
    """Id of a bibliographic record by doi, else pmid, else title.

    A title without any letter or digit of a-z, 0-9 stands for itself (else all such records would share an id).
    """
    named = normalize_title(title)
    basis = (
        F.when(normalize_doi(doi) != "", F.concat(F.lit("doi:"), normalize_doi(doi)))
        .when(text(pmid) != "", F.concat(F.lit("pmid:"), text(pmid)))
        .when(named != "", F.concat(F.lit("title:"), named))
        .otherwise(F.concat(F.lit("title:"), text(title)))
    )
    return F.concat(F.lit("P"), F.substring(F.sha1(basis), 1, 12))


def paper_id_v2(pmid: Column, doi: Column) -> Column:
    """Id of the second generation: pmid first."""
    basis = F.when(text(pmid) != "", F.concat(F.lit("pmid:"), text(pmid))).otherwise(F.concat(F.lit("doi:"), F.lower(strip(text(doi)))))
    return F.concat(F.lit("PV2"), F.substring(F.sha1(basis), 1, 12))


def child_id(parent: Column, kind: str, number: Column) -> Column:
    """``<parent>-OBS01`` or ``<parent>-ATT01``."""
    return F.format_string(f"%s-{kind}%02d", parent, number)


def pmcid(col: Column) -> Column:
    return F.when(F.startswith(F.upper(text(col)), F.lit("PMC")), text(col)).otherwise(F.concat(F.lit("PMC"), text(col)))


def url_key(url: Column) -> Column:
    """Key of a response in the cache table."""
    return F.sha2(url, 256)


def lookup_url(base: str, doi: Column, pmid: Column, title: Column) -> Column:
    """Search URL of a point lookup, by doi, else pmid, else title; null without any."""
    query = (
        F.when(normalize_doi(doi) != "", F.concat(F.lit('DOI:"'), normalize_doi(doi), F.lit('"')))
        .when(text(pmid) != "", F.concat(F.lit("EXT_ID:"), text(pmid)))
        .when(text(title) != "", F.concat(F.lit('TITLE:"'), text(title), F.lit('"')))
    )
    return F.concat(F.lit(base + "?query="), F.url_encode(query))


def is_true(col: Column) -> Column:
    return F.lower(strip(text(col))) == "true"


def binomial(organism: Column) -> Column:
    """The first two words of the first organism named."""
    first = F.element_at(F.split(text(organism), r"[/,]| and | or "), 1)
    return F.array_join(F.slice(F.split(collapse(first), " "), 1, 2), " ")


def strain_resolvable(strain: Column, markers: list[str], unknown: tuple[str, ...] = ("", "n/a", "unknown")) -> Column:
    low = F.lower(strip(text(strain)))
    marked = F.lit(False)
    for marker in markers:
        marked = marked | F.contains(low, F.lit(marker.lower()))
    return ~low.isin(*unknown) & ~marked


def strain_token(strain: Column) -> Column:
    return strip(F.element_at(F.split(text(strain), r"\("), 1))


def assembly_columns(accession: Column) -> tuple[Column, Column]:
    """(RefSeq accession, GenBank accession): the one that the prefix names, the other empty."""
    return tuple(F.when(F.startswith(text(accession), F.lit(p)), text(accession)).otherwise("") for p in ("GCF_", "GCA_"))


def matches(col: Column, pattern: str) -> Column:
    """The sorted distinct whole matches of a case-sensitive pattern."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text(col), F.lit(pattern), F.lit(0))))


def collection_strains(col: Column, prefixes: list[str]) -> Column:
    """Culture-collection numbers, like ``DSM 14401``."""
    return matches(col, rf"\b(?:{'|'.join(prefixes)})\s?-?\s?\d{{2,6}}(?:\.\d+)?\b")


def accessions(col: Column, patterns: dict[str, str]) -> Column:
    """Map of kind to its sorted distinct matches; kinds without any are left out. Kinds may overlap."""
    entries = F.array(*(F.struct(F.lit(kind).alias("key"), matches(col, rx).alias("value")) for kind, rx in patterns.items()))
    return F.map_from_entries(F.filter(entries, lambda e: F.size(e["value"]) > 0))

"""Entity resolution of bibliographic records.

Two modes. ``components`` is order-free: records that share a doi, pmid or normalised title are one entity, transitively. ``greedy``
gives what adding the records one after another to a store would: a record joins the entity that has its doi, else its pmid, else its
title, and enriches it, which can make its keys match later records. Every greedy merge runs along a shared key, so components bound it: each
component's records are folded in order, streamed through a task, which holds only the component's entities.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ids
from .graph import components

FIELDS = ("doi", "pmid", "pmcid", "year", "journal", "authors")
HISTORY = 2000
_TEXT, _SET = T.StringType(), T.ArrayType(T.StringType())
_KINDS = {"discovery_route": _SET, "is_review": T.BooleanType(), "full_text_available": T.BooleanType(), "n_records": T.LongType()}
_ENTITY = T.StructType([T.StructField(n, _KINDS.get(n, _TEXT)) for n in ("paper_id", "title", *FIELDS, "source_database", "discovery_route", "discovery_query", "review_seed_doi", "is_review", "full_text_available", "processing_status", "notes", "n_records")])


def with_keys(records: DataFrame) -> DataFrame:
    """Adds ``keys``: the record's doi, pmid and title keys, in order of precedence."""
    doi, pmid, title = ids.normalize_doi(F.col("doi")), ids.text(F.col("pmid")), ids.normalize_title(F.col("title"))
    keys = F.array(*(F.when(c != "", F.concat(F.lit(f"{k}:"), c)) for k, c in (("doi", doi), ("pmid", pmid), ("title", title))))
    return records.withColumn("keys", F.array_compact(keys))


def record_components(records: DataFrame, order_col: str) -> DataFrame:
    """``order_col, component``: the smallest order number of the records that are linked by shared keys.

    A key's records are linked to its first one, so a key of a third of all records gives as many edges as records, no more.
    """
    keyed = with_keys(records).select(F.col(order_col).alias("n"), F.explode("keys").alias("key"))
    first = keyed.groupBy("key").agg(F.min("n").alias("first"))
    edges = keyed.join(first, "key").select(F.col("n").alias("u"), F.col("first").alias("v"))
    roots = components(edges)
    return records.select(order_col).join(roots, records[order_col] == roots["node"], "left").select(order_col, F.coalesce("root", order_col).alias("component"))


def resolve_components(records: DataFrame, order_col: str = "n") -> DataFrame:
    """``component, n_records, paper_id, title, doi``: an entity for each component, with its first non-empty values in order.

    First values come from mergeable aggregates (the smallest struct of order and value), so a large component is combined before the shuffle.
    """
    of = record_components(records, order_col)
    every = records.join(of, order_col)

    def first(name: str):
        value = ids.text(F.col(name))
        return F.coalesce(F.min(F.when(value != "", F.struct(order_col, value.alias("v"))))["v"], F.lit("")).alias(name)

    found = every.groupBy("component").agg(F.count("*").alias("n_records"), first("title"), first("doi"), first("pmid"))
    return found.withColumn("paper_id", ids.paper_id(F.col("doi"), F.col("pmid"), F.col("title")))


class _Store:
    """Entities of one component, found by key; a later entity takes over a key that it shares with an earlier one."""

    def __init__(self):
        self.entities: list[dict] = []
        self.by_key: dict[str, dict] = {}

    def add(self, r: dict) -> None:
        entity = next((self.by_key[k] for k in r["keys"] if k in self.by_key), None)
        if entity is None:
            entity = {f: r[f] for f in ("title", "source_database", "processing_status", *FIELDS)}
            entity |= {"discovery_route": {r["discovery_route"]}, "discovery_query": r["discovery_query"], "review_seed_doi": r["review_seed_doi"], "is_review": bool(r["is_review"]), "full_text_available": bool(r["full_text_available"]), "notes": r["notes"], "n_records": 0, "title_key": [k for k in r["keys"] if k.startswith("title:")], "paper_id": r["paper_id"]}
            self.entities.append(entity)
        else:
            entity |= {f: r[f] for f in FIELDS if r[f] and not entity[f]}
            entity["is_review"] |= bool(r["is_review"])
            entity["full_text_available"] |= bool(r["full_text_available"])
            entity["discovery_route"].add(r["discovery_route"])
            for name, gap, most, always in (("discovery_query", " || ", HISTORY, False), ("review_seed_doi", "; ", None, False), ("notes", " || ", HISTORY, True)):
                if r[name] and (always or r[name] not in entity[name]):
                    entity[name] = gap.join(filter(None, (entity[name], r[name])))[:most]
        entity["n_records"] += 1
        doi = entity["doi"].strip().lower().removeprefix("https://doi.org/").removeprefix("doi:")
        for key in ([f"doi:{doi}"] if doi else []) + ([f"pmid:{entity['pmid']}"] if entity["pmid"] else []) + entity["title_key"]:
            self.by_key[key] = entity

    def numbered(self, component: int | None) -> list[dict]:
        return [e | {"component": component, "entity": i} for i, e in enumerate(self.entities, 1)]


#: Text columns of a record that an entity is made of.
RECORD_TEXTS = ("title", *FIELDS, "source_database", "discovery_route", "discovery_query", "review_seed_doi", "processing_status", "notes")
RECORD_FLAGS = ("is_review", "full_text_available")


def filled_records(records: DataFrame, order_col: str) -> DataFrame:
    """Records with all columns that the fold reads: missing and null ones empty or false, with ``keys`` and ``paper_id``."""
    texts = [ids.text(F.col(c) if c in records.columns else F.lit("")).alias(c) for c in RECORD_TEXTS]
    flags = [(F.coalesce(F.col(c), F.lit(False)) if c in records.columns else F.lit(False)).alias(c) for c in RECORD_FLAGS]
    return with_keys(records.select(order_col, *texts, *flags)).withColumn("paper_id", ids.paper_id(F.col("doi"), F.col("pmid"), F.col("title")))


def fold(every: DataFrame, order_col: str) -> DataFrame:
    """Entities, with ``component`` and their number in it (``entity``, from 1), of :func:`filled_records` that know their ``component``."""
    schema = T.StructType([T.StructField("component", T.LongType()), T.StructField("entity", T.IntegerType()), *_ENTITY.fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, component = _Store(), None
        for batch in batches:
            done: list[dict] = []
            for record in batch.to_dict("records"):
                if record["component"] != component:
                    done += store.numbered(component)
                    store, component = _Store(), record["component"]
                store.add(record)
            yield _rows(done, schema.names)
        yield _rows(store.numbered(component), schema.names)

    together = every.repartition("component").sortWithinPartitions("component", order_col)
    return together.mapInPandas(run, schema)


def resolve_greedy(records: DataFrame, order_col: str = "n") -> DataFrame:
    """The entities that adding ``records`` in the order of ``order_col`` gives, with the store's merge policy.

    Columns missing from ``records`` count as empty. A component is one task's work, but not its memory: records stream by.
    """
    every = filled_records(records, order_col)
    return fold(every.join(record_components(every, order_col), order_col), order_col).select(*_ENTITY.names)


def _rows(entities: list[dict], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame([e | {"discovery_route": sorted(filter(None, e["discovery_route"]))} for e in entities], columns=names)


def append_new(present: DataFrame, more: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """``present``, then the first row of each key of ``more`` that it lacks (columns by name): the first by ``order_col``, else the smallest row.

    ``order_col`` may be a column that ``present`` lacks; it is left out of the result then.
    """
    names = [c for c in more.columns if c in present.columns and c != key]
    order = [order_col] if order_col else []
    first = more.groupBy(key).agg(F.min(F.struct(*order, *(F.col(c).alias(f"_{c}") for c in names))).alias("r")).select(key, *(F.col(f"r._{c}").alias(c) for c in names))
    return present.unionByName(first.join(present.select(key), key, "left_anti"))


def split_routes(records: DataFrame, route_col: str = "discovery_route", order_col: str = "n") -> DataFrame:
    """One record for each route of a compound one (``a|b``), in their order, numbered anew by ``order_col``: a struct of the old number and the place.

    A record without a route stays as one.
    """
    each = records.withColumn("_routes", F.filter(F.split(F.coalesce(F.col(route_col), F.lit("")), r"\|"), lambda r: F.trim(r) != ""))
    rows = each.select(*(c for c in records.columns if c not in (route_col, order_col)), F.col(order_col).alias("_n"), F.posexplode_outer("_routes").alias("_place", "_route"))
    return rows.withColumns({route_col: F.coalesce(F.trim("_route"), F.lit("")), order_col: F.struct(F.col("_n").alias("n"), F.coalesce("_place", F.lit(0)).alias("place"))}).drop("_n", "_place", "_route")

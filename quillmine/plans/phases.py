"""The phases of a discovery run over stored tables (T5, section 3.2): search, citations, screen, extract, reports.

A store is a folder of keyed tables, to which phases commit their changes; one that is stopped leaves the tables as they were and can be run
again, and several may run at once: a phase that meets another's commit makes its change anew. No two papers have one pmid. The outside world is in
the inputs: records, hits, citation edges and full-text passages come as tables, the model as a chat client.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text, vocabulary
from ..operators import chat, discovery, graph, reports, state
from ..operators.lineage import cut
from ..sources.keyed import KeyedTable

PHASES = ("search", "citations", "screen", "extract", "reports")
_STRING, _SET = T.StringType(), T.ArrayType(T.StringType())
PAPERS = T.StructType([T.StructField(n, _STRING) for n in ("paper_id", *discovery.PAPER_TEXTS)] + [T.StructField(n, _SET) for n in discovery.PAPER_SETS] + [T.StructField("processing_status", _STRING), T.StructField("fulltext_status", _STRING), T.StructField("candidate_score", T.DoubleType())])
ATTEMPTS = T.StructType([T.StructField(n, _STRING) for n in ("attempt_id", "paper_id", *chat.ATTEMPT_TEXTS, "wild_type_status", "outcome", "evidence_method", "evidence_result")] + [T.StructField(f"{b}_chunk_ids", _SET) for b in ("methods", "results", "supplement")] + [T.StructField("needs_review", T.BooleanType())])


@dataclass(frozen=True)
class Inputs:
    """records: flat bibliographic records; hits: pmid, source, query, seed; edges: src, dst, label (pmids); passages: as of a full-text source."""

    records: DataFrame
    hits: DataFrame
    edges: DataFrame
    passages: DataFrame


class Store:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str, schema: T.StructType) -> KeyedTable:
        key = "attempt_id" if name == "attempts" else "paper_id"
        return KeyedTable(self.spark, f"{self.folder}/{name}", schema, key, ("pmid",) if name == "papers" else ())

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.table(name, schema).read()


def _upsert(store: Store, new: DataFrame) -> dict[str, int]:
    """Merge papers into those of the store; rows of other papers are not written. How many were new and enriched, counted by the write."""
    new = cut(new.select(*((F.col(f.name) if f.name in new.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in PAPERS.fields)))
    keys = new.select("paper_id").distinct()

    def change(papers: DataFrame) -> tuple[DataFrame, None]:
        touched = papers.join(keys, "paper_id", "left_semi")
        merged = state.upsert(touched, new, "paper_id", sets=discovery.PAPER_SETS, monotone="processing_status")
        marked = merged.join(touched.select("paper_id", F.lit(1).alias("_known")), "paper_id", "left")
        seen.append(Observation())  # a change that is made anew is counted anew
        return marked.observe(seen[-1], F.count_if(F.col("_known").isNull()).alias("new"), F.count_if(F.col("_known").isNotNull()).alias("enriched")).drop("_known"), None

    seen: list[Observation] = []
    store.table("papers", PAPERS).commit(change)
    return seen[-1].get


def search(store: Store, inputs: Inputs) -> dict[str, int]:
    return _upsert(store, discovery.hits_to_papers(inputs.records, inputs.hits))


def citations(store: Store, inputs: Inputs, depth: int = 1, max_seeds: int | None = None) -> dict[str, int]:
    """Papers within ``depth`` steps of the seeds come in, tagged with the papers and edge labels that led to them."""
    papers = store.read("papers", PAPERS)
    seeds = graph.outcome_seeds(papers, store.read("attempts", ATTEMPTS))
    reached = graph.breadth_first(inputs.edges, seeds, depth, max_seeds)
    near = inputs.edges.join(reached.where(F.col("hop") < depth).select(F.col("node").alias("src")), "src", "left_semi")
    hits = near.select(F.col("dst").alias("pmid"), F.col("label").alias("source"), F.concat_ws(":", "label", "src").alias("query"), F.col("src").alias("seed"))
    return _upsert(store, discovery.hits_to_papers(inputs.records, hits))


def screen(store: Store, inputs: Inputs) -> None:
    papers = store.read("papers", PAPERS)
    open_ = papers.where(F.col("processing_status").isin("metadata_fetched", "discovered"))
    screened = discovery.screen(open_, inputs.passages.join(open_.select("paper_id"), "paper_id", "left_semi"))
    _upsert(store, screened)


def extract(store: Store, inputs: Inputs, client: chat.Client, limit: int = 0) -> None:
    """Relevant papers with chunks are asked about, best first; their attempts replace earlier ones."""
    papers = store.read("papers", PAPERS)
    relevant = papers.where("processing_status = 'screened_relevant'")
    packets = discovery.chunk_packets(inputs.passages.join(relevant.select("paper_id"), "paper_id", "left_semi"), relevant)
    queue = packets.join(relevant.select("paper_id", "candidate_score"), "paper_id").orderBy(F.desc("candidate_score"), "paper_id")
    queue = queue.limit(limit) if limit else queue
    buckets = ("methods", "results", "supplement")
    part = lambda b: F.when(F.size(f"{b}_chunks") > 0, F.concat(F.lit(f"## {b}\n"), F.array_join(F.transform(f"{b}_chunks", lambda c: c["context"]), "\n")))
    said = F.array_join(F.flatten(F.array(*(F.transform(f"{b}_chunks", lambda c: c["context"]) for b in buckets))), " ")
    asked = queue.select("paper_id", F.concat_ws("\n\n", *map(part, buckets)).alias("prompt"), text.sentences(said).alias("sentences"), *(F.transform(f"{b}_chunks", lambda c: c["chunk_id"]).alias(f"{b}_chunk_ids") for b in buckets))
    answered = chat.ask(asked, client, chat.attempt_system(vocabulary.ATTEMPT_OUTCOMES, vocabulary.ATTEMPT_WILD_TYPES, vocabulary.FAILURE_REASONS))
    answered = cut(answered.where("reply IS NOT NULL"))  # calls are dear: what follows reads what was answered
    store.table("replies", answered.schema).put(answered)
    new = cut(chat.attempts(answered, vocabulary.ATTEMPT_OUTCOMES, vocabulary.ATTEMPT_WILD_TYPES))

    def change(attempts: DataFrame) -> tuple[DataFrame, DataFrame]:
        stale = attempts.join(answered.select("paper_id"), "paper_id", "left_semi").select("attempt_id").join(new.select("attempt_id"), "attempt_id", "left_anti")
        return new, stale

    store.table("attempts", ATTEMPTS).commit(change)
    _upsert(store, answered.select("paper_id", F.lit("extraction_complete").alias("processing_status")))


def report_tables(store: Store) -> dict[str, DataFrame]:
    """The report tables by name."""
    papers, tried = store.read("papers", PAPERS), store.read("attempts", ATTEMPTS)
    ranked = papers.select("paper_id", "pmid", "pmcid", "doi", "title", "journal", "year", "fulltext_status", "discovery_sources", "candidate_score", "processing_status").orderBy(F.desc("candidate_score"), "paper_id")
    return {
        "discovered_papers": ranked,
        "high_priority_candidates": ranked.where(F.col("processing_status").isin("screened_relevant", "extraction_complete")).select("paper_id", "pmid", "pmcid", "doi", "title", "candidate_score", "processing_status"),
        "fulltext_unavailable": papers.where("fulltext_status = 'unavailable_from_pmc'").select("paper_id", "pmid", "doi", "title", "journal", "year"),
        "engineering_attempts": reports.attempt_report(tried, papers), "failures": reports.attempt_report(tried, papers, "failure"), "successes": reports.attempt_report(tried, papers, "success"),
        "partial_successes": reports.attempt_report(tried, papers, "partial_success"), "needs_review": reports.attempt_report(tried.where("needs_review"), papers),
        "status_counts": reports.count_by(papers, "processing_status"), "source_counts": reports.tally(papers, "discovery_sources"), "attempt_summary": reports.attempt_summary(tried),
        "outcome_counts": reports.count_by(tried, "outcome"), "technique_counts": reports.count_by(tried.where("technique_normalized <> ''"), "technique_normalized"), "multi_strain_papers": reports.multi_strain_papers(tried),
    }


def run(spark: SparkSession, folder: str, inputs: Inputs, client: chat.Client | None = None, phases: tuple[str, ...] = PHASES, depth: int = 1) -> dict[str, DataFrame]:
    """Run phases in order; without a client the extract phase is left out. Returns the report tables."""
    store = Store(spark, folder)
    steps = {"search": lambda: search(store, inputs), "citations": lambda: citations(store, inputs, depth), "screen": lambda: screen(store, inputs), "extract": lambda: client and extract(store, inputs, client)}
    for name in phases:
        if name in steps:
            steps[name]()
    return report_tables(store) if "reports" in phases else {}

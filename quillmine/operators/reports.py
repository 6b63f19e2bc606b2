"""Report tables (2.A, J1-J3, A1-A18, S4, S35, P15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def attempt_summary(attempts: DataFrame) -> DataFrame:
    """One row of totals: attempts, papers, species, strains of species, explicit wild types, flagged.

    A strain is counted with its species; a null species leaves it out, an empty one doesn't.
    """
    named = F.col("strain") != ""
    return attempts.agg(
        F.count("*").alias("n_attempts"), F.count_distinct("paper_id").alias("n_papers"), F.count_distinct(F.when(F.col("species") != "", F.col("species"))).alias("n_species"),
        F.count_distinct(F.when(named, F.concat("species", F.lit("|"), "strain"))).alias("n_strains"),
    )


def observation_summary(observations: DataFrame) -> DataFrame:
    """One row: observations, distinct organisms, distinct pairs of organism and strain (A13). Empty and missing names are values like others, and one."""
    organism, strain = F.coalesce("organism_name", F.lit("")), F.coalesce("strain_name", F.lit(""))
    return observations.agg(F.count("*").alias("n_observations"), F.count_distinct(organism).alias("n_organisms"), F.count_distinct(F.struct(organism.alias("o"), strain.alias("s"))).alias("n_strains"))


def titled(observations: DataFrame, papers: DataFrame, width: int = 90, key: str = "paper_id") -> DataFrame:
    """``observations`` with ``paper_title``, the first ``width`` characters of their papers' titles; empty without a paper (J6). Of papers with one id the smallest title counts."""
    names = papers.groupBy(key).agg(F.min("title").alias("_title"))
    return observations.drop("paper_title").join(names, key, "left").withColumn("paper_title", F.left(F.coalesce("_title", F.lit("")), F.lit(width))).drop("_title")


def multi_strain_papers(attempts: DataFrame) -> DataFrame:
    """``paper_id, n_strains`` of papers with more than one strain."""
    return attempts.where(F.col("strain") != "").groupBy("paper_id").agg(F.count_distinct("strain").alias("n_strains")).where(F.col("n_strains") > 1)


def attempt_report(attempts: DataFrame, papers: DataFrame, outcome: str | None = None) -> DataFrame:
    """Attempts with their papers' identifiers and titles, all or of one outcome, in the order of the report."""
    rows = attempts if outcome is None else attempts.where(F.col("outcome") == outcome)
    named = papers.select("paper_id", "pmid", "doi", F.col("title").alias("paper_title"))
    return rows.join(named, "paper_id").orderBy("paper_id", "attempt_id")


def review_export(observations: DataFrame, matches: DataFrame, papers: DataFrame, order_col: str, where: Column | None = None) -> DataFrame:
    """Observations with their match and paper: of several matches of one observation the last by ``order_col`` counts.

    Without a match the status is ``not_yet_matched``; other missing values are empty.
    """
    values = [c for c in matches.columns if c not in ("observation_id", order_col)]
    last = matches.groupBy("observation_id").agg(F.max(F.struct(order_col, *values)).alias("m")).select("observation_id", *(F.col(f"m.{c}").alias(c) for c in values))
    named = papers.select("paper_id", "title", "doi")
    rows = observations if where is None else observations.where(where)
    out = rows.join(last, "observation_id", "left").join(named, "paper_id", "left")
    out = out.withColumn("genome_match_status", F.coalesce("genome_match_status", F.lit("not_yet_matched")))
    return out.na.fill("")


def verified_ratio(observations: DataFrame, flags_col: str = "qc_flags", flag: str = "evidence_unverified") -> DataFrame:
    """``n_total, n_unverified, n_verified``: observations whose quotes were found in their source, by the absence of a flag."""
    flagged = F.contains(F.coalesce(F.col(flags_col), F.lit("")), F.lit(flag))
    return observations.agg(F.count("*").alias("n_total"), F.count_if(flagged).alias("n_unverified"), F.count_if(~flagged).alias("n_verified"))


def readiness(rows: DataFrame, body_col: str = "body", abstract_col: str = "abstract") -> DataFrame:
    """``n_full, n_abstract_only, n_neither`` in one pass: papers with a cached full text, with an abstract only, with neither."""
    full, abstract = F.col(body_col).isNotNull(), F.coalesce(F.col(abstract_col), F.lit("")) != ""
    return rows.agg(F.count_if(full).alias("n_full"), F.count_if(~full & abstract).alias("n_abstract_only"), F.count_if(~full & ~abstract).alias("n_neither"))


def ranked_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """Counts by ``keys``, the largest first."""
    return count_by(rows, *keys).orderBy(F.desc("n"), *keys)


def preview(rows: DataFrame, order_cols: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows of a report."""
    return rows.orderBy(*order_cols).limit(n)


def tally(rows: DataFrame, set_col: str) -> DataFrame:
    """``value, n``: how many rows hold each element of an array of distinct values."""
    return rows.select(F.explode(set_col).alias("value")).groupBy("value").agg(F.count("*").alias("n"))


def categorised(col: Column, labels: dict[str, list[str]], default: str = "other") -> Column:
    """The first label of which the lower-cased value contains a stem."""
    out = F.lit(default)
    for label, stems in reversed(labels.items()):
        hit = F.lit(False)
        for stem in stems:
            hit = hit | F.contains(F.lower(col), F.lit(stem))
        out = F.when(hit, F.lit(label)).otherwise(out)
    return out


def triage_summary(triage: DataFrame) -> DataFrame:
    """Conditional counts of the triage table in one pass."""
    yes, no, maybe = (F.col("decision") == d for d in ("yes", "no", "maybe"))
    forced = ~F.col("abstract_available")
    return triage.agg(
        F.count("*").alias("n_triaged"), F.count_if(yes).alias("n_yes"), F.count_if(no).alias("n_no"), F.count_if(maybe).alias("n_maybe"),
        F.count_if(forced).alias("n_forced"), F.count_if(maybe & ~forced).alias("n_genuine_maybe"),
    )


def backlog(counts: DataFrame, stages: list[str]) -> DataFrame:
    """A row of counts by stage, with what each stage still has to do and the largest backlog."""
    steps = {f"backlog_{b}": F.greatest(F.lit(0), F.col(f"n_{a}") - F.col(f"n_{b}")) for a, b in zip(stages, stages[1:], strict=False)}
    return counts.withColumns(steps).withColumn("largest_backlog", F.greatest(*map(F.col, steps)) if len(steps) > 1 else F.col(next(iter(steps))))

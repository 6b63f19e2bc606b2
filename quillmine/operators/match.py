"""Match organisms and strains to a catalogue (section 2.G, W6, J18)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from .lineage import cut

# Markers of strains that cannot be resolved.
UNRESOLVED = ["not specified", "unspecified", "exact designation not", "exact strain", "not in abstract", "not individually specified"]
STATUSES = ["not_checked", "no_genome_found", "exact_strain_match", "multiple_possible_matches", "species_only_match"]


#: Length of the pieces that the index holds; a shorter token is a piece of its own length.
GRAM = 4
#: Entries that hold a piece, beyond which its tokens and entries meet in several tasks.
SALT_ROWS = 4096
#: Hashes of pieces that are broadcast, 8 bytes each; more are joined by a shuffle.
BROADCAST_PIECES = 1 << 18


def _pieces(text: Column, size: int) -> Column:
    """The distinct substrings of ``size`` characters."""
    n = F.length(text) - size + 1
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(text, i, F.lit(size))))).otherwise(F.array().cast("array<string>"))


def _few(keys: DataFrame, most: int) -> DataFrame:
    """``keys`` (written down already) to be broadcast if they are few, else for a sort-merge join, whatever their estimated size."""
    return F.broadcast(keys) if keys.count() <= most else keys.hint("merge")


def containing(tokens: DataFrame, entries: DataFrame, gram: int = GRAM, salt_rows: int = SALT_ROWS) -> DataFrame:
    """``group, token`` and the columns of the entries of the group whose ``text`` contains the token (all of them, and no other).

    ``tokens``: group, token (distinct, not empty); ``entries``: group, text and more. An inverted index of the pieces of the distinct texts, of which only those are made that
    some token of the group has, counts how many texts hold each. A token asks for its rarest piece alone, and the texts that hold
    it are looked through. The texts of a frequent piece are dealt over several tasks by a salt. Nothing is joined on the group alone.

    The index holds 64 bits of hash of a piece with its group and of a text with its group; equal hashes of unlike ones only add texts to look through. Spark takes what is
    made of a small file for small, however many rows come of it, so every join that grows with the input is told to be no broadcast.
    """
    size = F.least(F.length("token"), F.lit(gram))
    hashed = F.xxhash64("group", "piece").alias("h")
    asked = tokens.select("group", "token", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("token") - size + 1), lambda i: F.substring("token", i, size)))).alias("piece"))
    asked = cut(asked.select("group", "token", F.length("piece").alias("size"), hashed))
    sizes = sorted(r["size"] for r in asked.select("size").distinct().collect()) or [gram]  # from 1 to gram
    wanted = cut(asked.select("h").distinct())
    tasks = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a small table makes many pieces
    texts = cut(entries.select("group", "text").distinct().withColumn("e", F.xxhash64("group", "text")).repartition(tasks, "e"))
    made = F.flatten(F.array(*(_pieces(F.col("text"), n) for n in sizes)))
    held = cut(texts.select("e", "group", F.explode(made).alias("piece")).select("e", hashed).join(_few(wanted, BROADCAST_PIECES), "h", "left_semi"))
    often = held.groupBy("h").agg(F.count("*").alias("n"))
    # a token with a piece that no text holds is in none
    ranked = asked.join(often.hint("merge"), "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = ranked.groupBy("group", "token").agg(F.min(F.struct("n", "h")).alias("r")).where("r.n > 0")
    rarest = cut(rarest.select("group", "token", "r.h", (F.col("r.n") / salt_rows).cast("int").alias("salts")))
    salted = rarest.select("group", "token", "h", F.explode(F.sequence(F.lit(0), "salts")).alias("salt"))
    rows = held.join(rarest.select("h", "salts").distinct().hint("merge"), "h").distinct().join(texts.hint("merge"), "e")
    rows = rows.select("group", "text", "h", F.pmod("e", F.col("salts") + 1).cast("int").alias("salt"))
    pairs = salted.join(rows.hint("merge"), ["group", "h", "salt"]).where(F.contains("text", "token")).select("group", "token", "text")
    return pairs.join(entries.hint("merge"), ["group", "text"])


def catalog_match(observed: DataFrame, catalog: DataFrame, id_col: str = "observation_id", markers: list[str] = UNRESOLVED) -> DataFrame:
    """``id, binomial, strain_token, genome_match_status, accession, n_strain_hits`` for each row of ``observed`` (id, organism_name, strain_name).

    ``catalog``: accession, organism, match_text, rank (the order in which entries count as first). Each distinct (binomial, strain token) is
    matched once and joined back. Entries of one species and text are one with a number and a first. What a species' entries say together is one aggregate; which of them name a strain, an
    index of pieces tells (:func:`containing`), so a species with many strains and many entries does not pair all of them.
    """
    named = observed.select(
        id_col, ids.binomial(F.col("organism_name")).alias("binomial"), F.lower(ids.strain_token(F.col("strain_name"))).alias("strain_token"),
        ids.strain_resolvable(F.col("strain_name"), markers).alias("resolvable"),
    )
    pairs = named.select("binomial", "strain_token", "resolvable").distinct()
    entries = catalog.select(ids.binomial(F.col("organism")).alias("group"), F.lower("match_text").alias("text"), "rank", "accession").where("accession IS NOT NULL")
    alike = cut(entries.groupBy("group", "text").agg(F.count("*").alias("n"), F.min(F.struct("rank", "accession")).alias("lead")))
    species = alike.groupBy("group").agg(F.sum("n").alias("n"), F.min("lead")["accession"].alias("first"))
    asked = pairs.where(F.col("resolvable") & (F.col("strain_token") != "") & F.col("binomial").isNotNull()).select(F.col("binomial").alias("group"), F.col("strain_token").alias("token")).distinct()
    hits = containing(asked, alike).groupBy("group", "token").agg(F.sum("n").alias("n_strain_hits"), F.min("lead")["accession"].alias("first_hit"))
    found = pairs.join(species.hint("merge"), pairs["binomial"] == species["group"], "left").drop("group")
    same = found["resolvable"] & (found["binomial"] == hits["group"]) & (found["strain_token"] == hits["token"])
    found = found.join(hits.hint("merge"), same, "left").drop("group", "token").withColumns({"n": F.coalesce("n", F.lit(0)), "n_strain_hits": F.coalesce("n_strain_hits", F.lit(0))})
    status = (
        F.when(F.size(F.split("binomial", " ")) < 2, "not_checked").when(F.col("n") == 0, "no_genome_found")
        .when(F.col("n_strain_hits") == 1, "exact_strain_match").when(F.col("n_strain_hits") > 1, "multiple_possible_matches").otherwise("species_only_match")
    )
    accession = F.when(status == "not_checked", F.lit("")).otherwise(F.coalesce("first_hit", "first", F.lit("")))
    found = found.select("binomial", "strain_token", "resolvable", status.alias("genome_match_status"), accession.alias("accession"), "n_strain_hits")
    return named.join(found.hint("merge"), ["binomial", "strain_token", "resolvable"]).select(id_col, "binomial", "strain_token", "genome_match_status", "accession", "n_strain_hits")

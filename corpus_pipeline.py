"""A corpus pipeline of five stages over ``documents``; each is written as Parquet and read again for the next.

Every stage works on all that the one before kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmine.llm import decontaminate, mixing, nearcopies, pii, toxicity
from quillmine.operators.lineage import cut, remove, use_checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Row keys that are broadcast, about 40 bytes each; beyond that documents and keys are joined by a shuffle.
BROADCAST_KEYS = 1 << 18


def _row_key(id_col: str, text_hash: Column) -> Column:
    """A row's id and text hash as one text, never null, so that joins on it need no null-safe form."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.coalesce(text_hash.cast("string"), F.lit("-"))).alias("_key")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS, _row_key("doc_id", F.xxhash64("text")))


def _small(keys: DataFrame) -> DataFrame:
    """``keys`` (written down already) to be broadcast if they are few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model finds toxic go.

    Rows are judged one by one: null and empty texts are not toxic and stay, as do repeated rows and null ids; an empty table stays
    empty. Columns other than those of ``documents`` are left out, as in every stage.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.grade(docs.select(*COLUMNS), model).where(~F.col("toxic")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies stays: that of the smallest doc_id, and of its rows one of the smallest text hash.

    Null and empty texts are copies of one another. A row without an id stays only where its component has no ids. Of rows
    with one id and text the smallest by source, language and length stays. Only the keys of rows that go are joined with the documents; texts are
    shuffled only of kept rows that are repeated, or where the keys are too many to be broadcast.
    """
    found = nearcopies.near_copies(docs).select("doc_id", "text_hash", "component", _row_key("doc_id", F.col("text_hash")))
    rows = cut(found.groupBy("component", "doc_id", "text_hash", "_key").agg(F.count("*").alias("n")))
    lead = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "_key", "n")
    leads = cut(rows.groupBy("component").agg(F.min(lead).alias("lead")).select("component", "lead._key", "lead.n"))
    others = cut(rows.join(leads.select("_key"), "_key", "left_anti").select("_key").union(leads.where("n > 1").select("_key")))
    keyed = _keyed(docs)
    single = keyed.join(_small(others), "_key", "left_anti")
    repeated = keyed.join(_small(cut(leads.where("n > 1").select("_key"))), "_key", "left_semi")
    first = F.row_number().over(Window.partitionBy("_key").orderBy("source", "lang", "n_chars"))
    return single.select(*COLUMNS).union(repeated.withColumn("_n", first).where("_n = 1").select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of ten words of a benchmark item (or a shorter item whole) go.

    Null and wordless texts stay; rows with one id and text share their fate; a document without an id is judged by its text.
    """
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = cut(found.where(F.size("hits") > 0).select(_row_key("doc_id", F.col("text_hash"))).distinct())
    return _keyed(docs).join(_small(gone), "_key", "left_anti").select(*COLUMNS)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kinds; n_chars follows the text where it changed.

    Every row stays, null texts as null; rows are read one by one.
    """
    found = pii.find_pii(docs.select(*COLUMNS), redact=True)
    n_chars = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", n_chars).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes, numbered from 0 in ``copy``; documents that it doesn't take go.

    Null and blank texts have no words, so a copy of theirs fills nothing; a null source is a source of its own. Rows alike in id,
    source and text stand one after another in their source. The texts are shuffled once, by row key and source, as the copies need them.
    """
    place = F.struct("n", "before", "each", "u")
    found = mixing.placed(docs).select(F.concat_ws(":", _row_key("doc_id", F.col("text_hash")), "source").alias("_at"), place.alias("p"))
    rows = _keyed(docs).withColumn("_at", F.concat_ws(":", "_key", "source")).drop("_key")
    rows = rows.withColumn("_i", F.row_number().over(Window.partitionBy("_at").orderBy("lang", "n_chars")))
    taken = rows.join(found, "_at").select(*COLUMNS, "_i", "p.*")
    taken = taken.withColumn("copies", mixing.copies(F.col("before") + F.col("_i"))).where("copies > 0")
    return taken.select(*COLUMNS, F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))).alias("copy"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("mixing", mix_sources),
]

#: The stages train models, hash with XXH64 and pass messages, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Their tables go to the folder that executors share; each goes when the next is written."""
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
        if i:
            remove(spark, f"{folder}/{i - 1}-{STAGES[i - 1][0]}")
    return docs

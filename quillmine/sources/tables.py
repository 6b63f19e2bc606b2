"""Text tables at the edge: CSV and JSON scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CSV = {"header": True, "quote": '"', "escape": '"'}

# Column orders of the text tables.
PAPERS_V1 = ["paper_id", "title", "doi", "pmid", "pmcid", "year", "journal", "authors", "source_database", "discovery_route", "discovery_query", "review_seed_doi", "is_review", "full_text_available", "processing_status", "notes"]
TRIAGE = ["paper_id", "title", "decision", "reason", "abstract_available"]
SPAN_INDEX = ["paper_id", "text_source", "n_sentences_total", "n_tagged_sentences", "n_manipulation", "n_success", "n_failure", "n_wild_type", "n_not_wild_type", "regex_accessions", "regex_strains", "has_signal"]
REVIEW_TABLE = ["review_paper_id", "review_title", "table_label", "table_caption", "row_index", "row_text", "organism_guess", "cited_doi", "cited_pmid", "cited_title", "cited_year", "cited_source", "matched_candidate_paper_id"]


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def text_schema(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def read_csv(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """All columns as text, missing values empty; a missing file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], text_schema(fields))
    return spark.read.options(**_CSV, multiLine=True, enforceSchema=False).schema(text_schema(fields)).csv(path).na.fill("")


def as_text(df: DataFrame, fields: list[str]) -> DataFrame:
    """The columns ``fields`` in order, as text: others dropped, missing ones empty, True and False capitalised, sets joined by ``|``."""

    def cell(name: str):
        if name not in df.columns:
            return F.lit("").alias(name)
        kind, col = df.schema[name].dataType, F.col(name)
        if isinstance(kind, T.BooleanType):
            col = F.when(col, "True").otherwise("False")
        elif isinstance(kind, T.ArrayType):
            col = F.array_join(F.array_sort(F.array_distinct(col)), "|")
        elif isinstance(kind, T.TimestampType):
            col = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        return F.coalesce(col.cast("string"), F.lit("")).alias(name)

    return df.select(*map(cell, fields))


def write_csv(df: DataFrame, path: str, fields: list[str], mode: str = "overwrite") -> None:
    """The header is written even without rows."""
    as_text(df, fields).write.options(**_CSV, emptyValue="").mode(mode).csv(path)


def write_packets(df: DataFrame, path: str, key: str | None = None, mode: str = "overwrite") -> None:
    """Nested rows as JSON lines; with ``key``, a folder for each of its values."""
    out = df.write.mode(mode)
    (out.partitionBy(key) if key else out).json(path)


def write_json_array(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """All rows as one JSON array in one file (S8). For reports of bounded size: one task writes it."""
    rows = df.agg(F.collect_list(F.struct(*df.columns)).alias("rows"))
    rows.select(F.to_json("rows")).coalesce(1).write.mode(mode).text(path)


def read_packets(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON packets; unreadable ones are kept with their text in ``_corrupt`` (filter them, or report them)."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    if not exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.options(mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt").schema(full).json(path)


def file_keys(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """``key``: the stems of the files in a folder. Their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(path).select("path")
    return files.select(F.regexp_extract("path", rf"([^/]*){suffix.replace('.', chr(92) + '.')}$", 1).alias("key"))


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a list, without blank ones and ``#`` comments."""
    lines = spark.read.text(path).select(F.trim("value").alias("value"))
    return lines.where((F.col("value") != "") & ~F.startswith("value", F.lit("#")))


def observation_ids(curated: DataFrame, paper_col: str = "paper_id", observations_col: str = "observations") -> DataFrame:
    """Rows of a curated table, one paper a row with an array of observation structs, with 1-based observation ids."""
    from ..functions.ids import child_id

    each = curated.select(paper_col, F.posexplode(observations_col).alias("i", "o"))
    return each.select(child_id(F.col(paper_col), "OBS", F.col("i") + 1).alias("observation_id"), paper_col, "o.*")


def modified(spark: SparkSession, path: str) -> int | None:
    """The time of the last change of a path, in milliseconds; None if it does not exist."""
    if not exists(spark, path):
        return None
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).getModificationTime()


def stale(spark: SparkSession, derived: str, source: str) -> bool:
    """Whether a derived table is missing or older than its source."""
    made, changed = modified(spark, derived), modified(spark, source)
    return made is None or (changed is not None and made < changed)

"""Incremental ingest as Structured Streaming (T1-T5): new files are merged into keyed state, batch by batch.

:func:`ingest_keyed` merges a batch with the rows of its own keys and commits these to a :class:`~quillmine.sources.keyed.KeyedTable`, so what it writes follows the batch, not
the state; commits carry the batch's number, so one that is run again counts once. :func:`ingest` is for merges that need the whole state: a folder of
numbered versions, of which a batch writes the next and the last KEPT stay for readers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lineage import remove
from ..operators.state import upsert
from ..sources.keyed import KeyedTable

#: Versions of a whole state that stay.
KEPT = 3


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete versions of a state folder."""
    fs, where = _fs(spark, folder)
    if not fs.exists(where):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(where)]
    done = [n for n in found if n.startswith("v") and _fs(spark, f"{folder}/{n}/_SUCCESS")[0].exists(_fs(spark, f"{folder}/{n}/_SUCCESS")[1])]
    return sorted(int(n[1:]) for n in done)


def read_state(spark: SparkSession, folder: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """The last version (before a batch); empty if there is none."""
    there = [v for v in versions(spark, folder) if before is None or v < before]
    return spark.read.schema(schema).parquet(f"{folder}/v{there[-1]}") if there else spark.createDataFrame([], schema)


def ingest(stream: DataFrame, folder: str, checkpoint: str, schema: T.StructType, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """Run all that is available of ``stream`` through ``merge(state, batch)`` and write each batch's state."""

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = read_state(spark, folder, schema, before=number)
        merge(old, batch).write.mode("overwrite").parquet(f"{folder}/v{number}")
        for v in versions(spark, folder)[:-KEPT]:
            remove(spark, f"{folder}/v{v}")

    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ingest_keyed(stream: DataFrame, table: KeyedTable, checkpoint: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """Run all that is available of ``stream`` into ``table``: ``merge(rows of the batch's keys, batch)`` takes their place.

    Other writers may commit to the table meanwhile; a batch that meets one is merged anew.
    """

    def step(batch: DataFrame, number: int) -> None:
        keys = batch.select(table.key).distinct()
        table.commit(lambda state: (merge(state.join(keys, table.key, "left_semi"), batch), None), token=f"{checkpoint}:{number}")

    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def paper_merge(key: str, sets: list[str], order_col: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Merge of discovery hits into papers by upsert."""
    return lambda old, new: upsert(old, new, key, sets=sets, order_col=order_col)


def deduplicated(stream: DataFrame, key: str, ts_col: str, lateness: str) -> DataFrame:
    """The first row of each key, remembered for ``lateness`` of event time."""
    return stream.withWatermark(ts_col, lateness).dropDuplicatesWithinWatermark([key])


def windowed_routes(stream: DataFrame, ts_col: str, route_col: str, width: str, lateness: str) -> DataFrame:
    """Hits of each route in tumbling windows of event time."""
    hits = stream.withWatermark(ts_col, lateness).groupBy(F.window(ts_col, width), route_col).agg(F.count("*").alias("n"))
    return hits.select(F.col("window.start").alias("start"), route_col, "n")

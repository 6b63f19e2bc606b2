"""Entity resolution that grows by batches: only what a batch touches is looked at again.

Three keyed tables hold what is known: each key's component, each record with its component, and each component's entities. A batch's records look up
their keys; components that they join are united under the smallest record number; keys, records and entities of united or grown components
are written anew, all others stay. Batches in the order of their records give what one run over all records gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.keyed import KeyedTable
from . import resolve
from .graph import components
from .lineage import cut

_LONG, _TEXT = T.LongType(), T.StringType()
_KEYS = T.StructType([T.StructField("key", _TEXT), T.StructField("root", _LONG)])
_RECORDS = T.StructType([T.StructField("n", _LONG), T.StructField("root", _LONG), *(T.StructField(c, _TEXT) for c in resolve.RECORD_TEXTS), *(T.StructField(c, T.BooleanType()) for c in resolve.RECORD_FLAGS)])
_ENTITIES = T.StructType([T.StructField("entity_id", _TEXT), T.StructField("component", _LONG), *resolve._ENTITY.fields])


class GrowingStore:
    """Entities in a folder. One writer adds batches; readers may read at any time. Numbers of records grow from batch to batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.keys = KeyedTable(spark, f"{folder}/keys", _KEYS, "key")
        self.records = KeyedTable(spark, f"{folder}/records", _RECORDS, "n")
        self.stored = KeyedTable(spark, f"{folder}/entities", _ENTITIES, "entity_id")

    def add(self, batch: DataFrame, name: str, order_col: str = "n") -> None:
        """Add records; ``name`` names the batch, which is added once however often it is given.

        A batch that was stopped is given again: its tables are written in an order in which each can be made from those after it.
        """
        new = cut(resolve.filled_records(batch.withColumnRenamed(order_col, "n"), "n").withColumn("n", F.col("n").cast("long")))
        asked = new.select("n", F.explode("keys").alias("key"))
        first = asked.groupBy("key").agg(F.min("n").alias("first"))
        known = cut(first.select("key").join(self.keys.read(), "key"))
        within = asked.join(first, "key").select(F.col("n").alias("u"), F.col("first").alias("v"))
        across = asked.join(known, "key").select(F.col("n").alias("u"), F.col("root").alias("v"))
        united = components(within.union(across))
        root = new.select("n").join(united, F.col("n") == F.col("node"), "left").select("n", F.coalesce("root", "n").alias("root"))
        root = cut(root)
        # components of before that now stand under another number
        moved = cut(known.select(F.col("root").alias("old")).distinct().join(united, F.col("old") == F.col("node")).where("old <> root").select("old", "root"))
        touched = cut(root.select("root").distinct())
        carried = self.records.read().join(moved.withColumnRenamed("root", "_to"), F.col("root") == F.col("old")).select("n", F.col("_to").alias("root"), *_RECORDS.names[2:])
        added = new.join(root, "n").select(*_RECORDS.names)
        self.records.put(carried.unionByName(added), token=name)
        gone = moved.select(F.col("old").alias("component")).union(touched.select("root")).distinct()
        every = resolve.filled_records(self.records.read().join(touched, "root", "left_semi"), "n").join(self.records.read().select("n", F.col("root").alias("component")), "n")
        entities = cut(resolve.fold(every, "n").withColumn("entity_id", F.concat_ws("-", "component", "entity")))
        stale = self.stored.read().join(gone, "component", "left_semi").select("entity_id").join(entities.select("entity_id"), "entity_id", "left_anti")
        self.stored.put(entities, stale, token=name)
        moved_keys = self.keys.read().join(moved.withColumnRenamed("root", "_to"), F.col("root") == F.col("old")).select("key", F.col("_to").alias("root"))
        new_keys = asked.join(root, "n").groupBy("key").agg(F.min("root").alias("root"))
        self.keys.put(new_keys.unionByName(moved_keys.join(new_keys, "key", "left_anti")), token=name)

    def entities(self) -> DataFrame:
        return self.stored.read().select(*resolve._ENTITY.names)

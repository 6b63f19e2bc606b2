"""Keyed tables that several writers may change at once: optimistic commits, unique columns, deltas that are merged on read.

A table is a folder. ``data/`` holds Parquet folders under names of their own: a base, and deltas of upserted and removed keys. ``log/`` holds
numbered manifests that say which of these make up the table, later deltas winning; the one with the highest number is the table. A
commit writes its delta, checks it against the manifest that it read, and publishes the next number only if nobody else has: the file appears whole or not at all,
and never over another. A writer that comes second reads what the first one wrote and makes its change anew, so no update is lost. What a commit
writes follows its change, not the table; now and then the deltas are folded into a new base.
"""

from __future__ import annotations

import contextlib
import json
import os
import random
import time
import uuid
from collections.abc import Callable
from urllib.parse import unquote, urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lineage import remove

#: Deltas after which a commit folds them into a base, and manifests that stay for readers.
FOLD, KEPT = 8, 4
#: Tokens of commits that a manifest remembers.
_TOKENS = 256
#: The change of a snapshot: rows to put in place of those with their keys, and keys that go (or None).
Change = Callable[[DataFrame], tuple[DataFrame, DataFrame | None]]


class NotUnique(ValueError):
    """A commit would give two rows one key, or one value of a unique column."""


class Conflict(RuntimeError):
    """Other writers were faster each time."""


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _linked(source: str, target: str) -> bool:
    """Publish a file of a file system that has links: atomic, and refused if the target is there."""
    try:
        os.link(source, target)
    except FileExistsError:
        return False
    return True


def _renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Publish a file by a rename that does not replace."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    a, b = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(a, b, options)
    except Py4JJavaError as e:
        if "AlreadyExists" in str(e.java_exception.getClass().getName()):
            return False
        raise
    return True


def publish(spark: SparkSession, target: str, text: str) -> bool:
    """Write a small file whole, unless there is one of that name: then False."""
    fs, where = _fs(spark, target)
    draft = f"{target.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    local = fs.getUri().getScheme() == "file"
    if local:
        path, draft = (unquote(urlsplit(p).path) if "://" in p or p.startswith("file:") else p for p in (target, draft))
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(draft, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            return _linked(draft, path)
        finally:
            os.unlink(draft)
    out = fs.create(_fs(spark, draft)[1], True)
    out.write(bytearray(text.encode()))
    out.close()
    done = False
    try:
        done = _renamed(spark, draft, target)
    finally:
        if not done:
            fs.delete(_fs(spark, draft)[1], False)
    return done


class KeyedTable:
    """Rows of ``schema`` by ``key``; each column in ``unique`` has no value twice, the empty text and null aside."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, key: str, unique: tuple[str, ...] = (), fold: int = FOLD):
        self.spark, self.folder, self.schema, self.key, self.unique, self.fold = spark, folder, schema, key, unique, fold

    # manifests

    def _numbers(self) -> list[int]:
        fs, where = _fs(self.spark, f"{self.folder}/log")
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _manifest(self, number: int) -> dict:
        fs, where = _fs(self.spark, f"{self.folder}/log/{number:012}.json")
        stream = fs.open(where)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def version(self) -> int:
        """The number of the last commit, 0 before the first."""
        return max(self._numbers(), default=0)

    def _last(self) -> tuple[int, dict]:
        number = self.version()
        return number, self._manifest(number) if number else {"base": None, "deltas": [], "tokens": []}

    # rows

    def _part(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.folder}/data/{name}")

    def _rows(self, manifest: dict) -> DataFrame:
        names = self.schema.names
        base = self._part(manifest["base"], self.schema) if manifest["base"] else self.spark.createDataFrame([], self.schema)
        if not manifest["deltas"]:
            return base
        full = T.StructType([*self.schema.fields, T.StructField("_gone", T.BooleanType())])
        changes = None
        for i, name in enumerate(manifest["deltas"]):
            part = self._part(name, full).withColumn("_n", F.lit(i))
            changes = part if changes is None else changes.unionByName(part)
        last = changes.groupBy(self.key).agg(F.max_by(F.struct("_gone", *(n for n in names if n != self.key)), "_n").alias("r"))
        latest = last.where("NOT r._gone").select(*(self.key if n == self.key else F.col("r")[n].alias(n) for n in names))
        return base.join(changes.select(self.key).distinct(), self.key, "left_anti").select(*names).unionByName(latest)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows as of a version (the last one). An older one can be read for as long as it is kept."""
        if version is None:
            return self._rows(self._last()[1])
        return self._rows(self._manifest(version))

    # commits

    def _write(self, upserts: DataFrame | None, removed: DataFrame | None) -> str:
        parts = []
        if upserts is not None and removed is not None:
            upserts = upserts.join(removed.select(self.key).distinct(), self.key, "left_anti")  # what is to go, goes
        if upserts is not None:
            columns = [(F.col(f.name) if f.name in upserts.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields]
            parts.append(upserts.select(*columns, F.lit(False).alias("_gone")).where(F.col(self.key).isNotNull()))
        if removed is not None:
            gone = removed.select(self.key).where(F.col(self.key).isNotNull()).distinct()
            parts.append(gone.select(*((F.col(self.key) if f.name == self.key else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields), F.lit(True).alias("_gone")))
        if not parts:
            raise ValueError("a commit needs rows to put or keys to remove")
        name = uuid.uuid4().hex
        both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        both.write.parquet(f"{self.folder}/data/{name}")
        return name

    def _check(self, manifest: dict, name: str) -> None:
        """Keys of a delta are there once; what it brings to a unique column is nowhere else in the table as it would be."""
        delta = self._part(name, T.StructType([*self.schema.fields, T.StructField("_gone", T.BooleanType())]))
        twice = delta.groupBy(self.key).agg(F.count("*").alias("_times")).where("_times > 1").limit(1).collect()
        if twice:
            raise NotUnique(f"{self.key} {twice[0][0]!r} is changed twice")
        after = self._rows(manifest | {"deltas": [*manifest["deltas"], name]}) if self.unique else None
        for column in self.unique:
            said = F.col(column).isNotNull() & (F.col(column).cast("string") != "")
            brought = delta.where(~F.col("_gone") & said).select(column).distinct()
            twice = after.where(said).join(brought, column, "left_semi").groupBy(column).agg(F.count("*").alias("_times")).where("_times > 1").limit(1).collect()
            if twice:
                raise NotUnique(f"{column} {twice[0][0]!r} would be that of {twice[0][1]} rows")

    def commit(self, change: Change, token: str | None = None, tries: int = 30) -> int:
        """Apply ``change`` to the last version and publish the result; the new version's number.

        If another writer publishes first, the change is made anew from what that one wrote. A ``token`` names the commit: one that the table has seen is not
        applied again, so a writer that does not know whether it was done may simply repeat it. Rows without a key are left out.
        """
        for n in range(tries):
            number, manifest = self._last()
            if token is not None and token in manifest["tokens"]:
                return number
            name = self._write(*change(self._rows(manifest)))
            try:
                self._check(manifest, name)
                tokens = (manifest["tokens"] + ([token] if token is not None else []))[-_TOKENS:]
                done = publish(self.spark, f"{self.folder}/log/{number + 1:012}.json", json.dumps(manifest | {"deltas": [*manifest["deltas"], name], "tokens": tokens}))
            except BaseException:
                remove(self.spark, f"{self.folder}/data/{name}")
                raise
            if done:
                if len(manifest["deltas"]) + 1 >= self.fold:
                    self.compact()
                return number + 1
            remove(self.spark, f"{self.folder}/data/{name}")
            time.sleep(random.random() * 0.05 * (n + 1))
        raise Conflict(f"{self.folder}: {tries} commits of others came first")

    def put(self, upserts: DataFrame | None = None, removed: DataFrame | None = None, token: str | None = None) -> int:
        """Rows in place of those with their keys, whatever these hold, and keys to remove."""
        return self.commit(lambda _: (upserts, removed), token)

    def rewrite(self, column: str, to: Callable[[Column], Column], token: str | None = None) -> int:
        """Put ``to`` of a column in its place wherever that changes it (P20); the other rows are not written. The last version's number."""

        def change(rows: DataFrame) -> tuple[DataFrame, None]:
            new = rows.withColumn("_new", to(F.col(column))).where(~F.col("_new").eqNullSafe(F.col(column)))
            return new.withColumn(column, F.col("_new")).drop("_new"), None

        return self.commit(change, token)

    def compact(self) -> bool:
        """Fold the deltas into a new base; False if another writer was faster (the table is as good as before). Older versions than KEPT go."""
        number, manifest = self._last()
        name = uuid.uuid4().hex
        self._rows(manifest).write.parquet(f"{self.folder}/data/{name}")
        done = publish(self.spark, f"{self.folder}/log/{number + 1:012}.json", json.dumps(manifest | {"base": name, "deltas": []}))
        if not done:
            remove(self.spark, f"{self.folder}/data/{name}")
            return False
        self._forget()
        return True

    def _forget(self) -> None:
        """Delete manifests beyond the last KEPT, and the data that only they name."""
        numbers = self._numbers()
        named = lambda some: {x for n in some for m in [self._manifest(n)] for x in [m["base"], *m["deltas"]] if x}
        old, kept = numbers[:-KEPT], numbers[-KEPT:]
        with contextlib.suppress(Py4JJavaError):  # another writer may be forgetting the same ones
            spare = named(old) - named(kept)
            for n in old:
                remove(self.spark, f"{self.folder}/log/{n:012}.json")
            for name in spare:
                remove(self.spark, f"{self.folder}/data/{name}")

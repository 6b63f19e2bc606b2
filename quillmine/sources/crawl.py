"""Paged discovery that can be stopped and resumed: a stream of requests that feeds itself.

A request is a row: a query, how many items it has had, and the URL of its next page. A micro-batch takes all open requests, gets their answers (from a table of
recorded ones, or through a transport), and writes the items, and for every query that goes on the request of its next page into the folder
that the stream reads. The cursor of a page is known only once the page before was read, on an executor, so it travels in the
request's row and never through the driver; the checkpoint says which requests were answered. A run that is stopped anywhere goes on
at the batch that it was in: that batch's folders are written again, so no page is lost or taken twice. Queries are rows, as many as there are.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.positions import pages as exact_pages
from .paging import CURSOR_PAGE, MOST_REFERENCES, OFFSET_PAGE, REFERENCE_PAGE, Transport, call
from .responses import PACE_S

#: (query, n, page, url) -> the same with ``body``, the answer's text or null
Answers = Callable[[DataFrame], DataFrame]
_REQUEST = "query string, n int, page int, url string"
_ITEM = "query string, place int, item string"


def _encoded(value: Column) -> Column:
    """As :mod:`paging` writes it, so that both find the same answers in a cache."""
    return F.replace(F.replace(F.url_encode(value), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _cursor_url(base: str, query: Column, n: Column, page: Column, cursor: Column, most: int) -> Column:
    head = F.concat(F.lit(f"{base}/search?query="), _encoded(query), F.lit(f"&format=json&resultType=core&pageSize={min(CURSOR_PAGE, most)}&cursorMark="))
    return F.concat(head, _encoded(cursor))


def _numbered_url(base: str, query: Column, n: Column, page: Column, cursor: Column, most: int) -> Column:
    return F.concat(F.lit(f"{base}/"), query, F.lit("/references?format=json&page="), page.cast("string"), F.lit(f"&pageSize={REFERENCE_PAGE}"))


def _offset_url(base: str, query: Column, n: Column, page: Column, cursor: Column, most: int) -> Column:
    size = F.least(F.lit(OFFSET_PAGE), F.lit(most) - n).cast("string")
    return F.concat(F.lit(f"{base}/esearch.fcgi?db=pubmed&term="), _encoded(query), F.lit("&retmode=json&retmax="), size, F.lit("&retstart="), n.cast("string"), F.lit("&sort=relevance"))


#: The URL of a style's page, the shape of its answer, its items, and the cursor of what follows.
_STYLES = {
    "cursor": (_cursor_url, "struct<resultList:struct<result:array<string>>,nextCursorMark:string>", "a.resultList.result", "a.nextCursorMark"),
    "numbered": (_numbered_url, "struct<referenceList:struct<reference:array<string>>>", "a.referenceList.reference", None),
    "offset": (_offset_url, "struct<esearchresult:struct<idlist:array<string>>>", "a.esearchresult.idlist", None),
}


def first_url(style: str, base: str, query: Column, most: int) -> Column:
    return _STYLES[style][0](base, query, F.lit(0), F.lit(1), F.lit("*"), most)


def page_url(style: str, base: str, query: Column, n: Column, page: Column, cursor: Column, most: int) -> Column:
    """The URL of the page number ``page`` (from 1), after ``n`` items, at ``cursor``."""
    return _STYLES[style][0](base, query, n, page, cursor, most)


def recorded(table: DataFrame, url_col: str = "url", body_col: str = "body") -> Answers:
    """Answers from a table of recorded ones alone; a URL that it lacks has none (S14). Of repeated URLs the smallest body counts."""
    bodies = table.groupBy(F.col(url_col).alias("url")).agg(F.min(body_col).alias("body"))
    return lambda requests: requests.join(bodies, "url", "left")


def called(transport: Transport, pace: float = PACE_S["default"], tasks: int = 1) -> Answers:
    """Answers of a service, asked by ``tasks`` tasks that together keep its pace."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = []
            for i, url in enumerate(batch.column(batch.schema.get_field_index("url")).to_pylist()):
                if i:
                    time.sleep(pace * tasks)
                body = call(transport, url, "json", pace * tasks)[1]
                bodies.append(body and body.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bodies, pa.string())], [*batch.schema.names, "body"])

    return lambda requests: requests.repartition(tasks, "query").mapInArrow(run, f"{_REQUEST}, body string")


def _read(requests: DataFrame, answers: Answers, style: str, base: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(items, next requests) of some requests."""
    url, shape, items, cursor = _STYLES[style]
    got = answers(requests).select("query", "n", "page", "url", F.from_json("body", shape).alias("a"))
    got = got.withColumn("all", F.coalesce(items, F.array().cast("array<string>"))).withColumn("items", F.slice("all", F.lit(1), F.greatest(F.lit(most) - F.col("n"), F.lit(0))))
    found = got.select("query", "n", F.posexplode("items").alias("i", "item")).select("query", (F.col("n") + F.col("i")).alias("place"), "item")
    had = F.size("all")
    if style == "cursor":
        # it ends at an empty page, without a cursor, or where the cursor stands still
        following = F.col(cursor)
        goes_on = (had > 0) & (F.coalesce(following, F.lit("")) != "") & (url(base, F.col("query"), F.col("n"), F.col("page"), following, most) != F.col("url"))
    else:
        following = F.lit("")
        size = F.lit(REFERENCE_PAGE) if style == "numbered" else F.least(F.lit(OFFSET_PAGE), F.lit(most) - F.col("n"))
        goes_on = had >= size
    n = F.col("n") + had
    open_ = got.where(goes_on & (n < most))
    following = url(base, F.col("query"), n, F.col("page") + 1, following, most)
    return found, open_.select("query", n.cast("int").alias("n"), (F.col("page") + 1).alias("page"), following.alias("url"))


def crawl(spark: SparkSession, folder: str, queries: DataFrame, answers: Answers, style: str, base: str, most: int = MOST_REFERENCES, query_col: str = "query") -> DataFrame:
    """``query, place, item``: the first ``most`` items of each distinct query, by the rules of its paging style (``cursor``, ``numbered``, ``offset``).

    ``folder`` holds the run: requests, items and checkpoint. If it holds one that was stopped, that is resumed and ``queries`` are not read again. A page without
    an answer, or one that can't be read, ends its query. Null queries ask nothing; without queries there are no rows.
    """
    inbox, items, log = f"{folder}/requests", f"{folder}/items", f"{folder}/checkpoint"
    if not _complete(spark, f"{inbox}/start"):
        asked = queries.select(F.col(query_col).cast("string").alias("query")).where("query IS NOT NULL").distinct()
        first = asked.select("query", F.lit(0).alias("n"), F.lit(1).alias("page"), first_url(style, base, F.col("query"), most).alias("url"))
        spark.createDataFrame([], _ITEM).write.mode("overwrite").parquet(f"{items}/none")
        first.write.mode("overwrite").parquet(f"{inbox}/start")

    def step(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return  # nothing is open: no file is written, so no further batch begins
        found, following = _read(batch, answers, style, base, most)
        found.write.mode("overwrite").parquet(f"{items}/batch={number}")
        following.write.mode("overwrite").parquet(f"{inbox}/after-{number}")

    stream = spark.readStream.schema(_REQUEST).parquet(f"{inbox}/*")
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", log).start()
    try:
        query.processAllAvailable()  # a batch's next requests are there before it ends, so all of them count as available
    finally:
        query.stop()
    return spark.read.schema(_ITEM).option("recursiveFileLookup", True).parquet(items)


def _complete(spark: SparkSession, path: str) -> bool:
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def record_pages(rows: DataFrame, style: str, base: str, most: int, query_col: str, item_col: str, order: list[str]) -> DataFrame:
    """``url, body``: the answers that a service over ``rows`` would give for each of their queries, in its style: what a cache holds after a crawl.

    Pages are cut by global positions, so a query with a third of all rows is no task's work. The cursor of a page is that of its first item's place.
    """
    size = {"cursor": min(CURSOR_PAGE, most), "numbered": REFERENCE_PAGE, "offset": OFFSET_PAGE}[style]
    listed = exact_pages(rows.where(F.col(query_col).isNotNull()), item_col, size, order, [query_col])
    query, page = F.col(query_col).cast("string"), F.col("page").cast("int")
    n = page * size
    values = F.col("values")
    if style == "cursor":
        body = F.struct(F.struct(F.transform(values, lambda v: F.struct(v.alias("id"))).alias("result")).alias("resultList"), F.concat(F.lit("at "), (n + F.size(values)).cast("string")).alias("nextCursorMark"))
        cursor = F.when(page == 0, "*").otherwise(F.concat(F.lit("at "), n.cast("string")))
    elif style == "numbered":
        body, cursor = F.struct(F.struct(F.transform(values, lambda v: F.struct(v.alias("id"))).alias("reference")).alias("referenceList")), F.lit("")
    else:
        body, cursor = F.struct(F.struct(values.alias("idlist")).alias("esearchresult")), F.lit("")
    asked = F.least(F.lit(size), F.lit(most) - n)
    kept = listed.where(n < most)
    if style == "offset":  # the service gives no more than it is asked for
        kept = kept.withColumn("values", F.slice("values", F.lit(1), asked))
    return kept.select(page_url(style, base, query, n, page + 1, cursor, most).alias("url"), F.to_json(body).alias("body"))

"""Mixing: reruns agree in any layout, and each source comes near its target, whatever ids and texts repeat."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillmine.llm import mixing


def taken(df):
    return Counter((r.doc_id, r.source, r["size"], r.copies) for r in mixing.mix(df).collect())


@pytest.fixture(scope="module")
def repeated(spark):
    """A third of the rows with one id, a third without, a source that holds most, repeated rows, extra columns with names of the result."""
    i = F.col("id")
    doc_id = F.when(i % 3 == 0, F.lit(7)).when(i % 3 == 1, F.lit(None)).otherwise(i)
    text = F.when(i % 11 == 0, F.lit(None)).when(i % 7 == 0, F.lit("one text for many rows")).otherwise(F.repeat(F.concat(i.cast("string"), F.lit(" ")), (i % 40).cast("int")))
    source = F.when(i % 5 == 0, F.lit("small")).when(i % 97 == 0, F.lit(None)).otherwise(F.lit("hot"))
    return spark.range(6000).select(doc_id.cast("long").alias("doc_id"), text.alias("text"), source.alias("source"), F.lit(1).alias("copies"), F.lit("x").alias("class")).cache()


def test_reruns_agree_in_any_layout(repeated):
    first = taken(repeated.coalesce(1))
    assert sum(first.values()) == 6000
    assert taken(repeated.repartition(9)) == first
    assert taken(repeated.orderBy(F.rand(3)).repartitionByRange(4, "text")) == first


def test_targets_are_met(repeated):
    got = mixing.mix(repeated).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("size").alias("size"), F.max("source_size").alias("source_size"), F.max("size").alias("most")).collect()
    assert {r.source for r in got} == {"small", "hot", None}
    for r in got:
        assert r["size"] == r.source_size and abs(r.taken - r.target) <= 2 * r.most + 0.01 * r.target


def test_copies_of_one_source_are_systematic(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    got = mixing.mix(docs, share=1.5).agg(F.sum("copies"), F.min("copies"), F.max("copies")).first()
    assert tuple(got) == (1500, 1, 2)  # each of 1.5 expected copies: the whole numbers crossed by 1,500

"""Check quoted evidence against its source text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text


def supported(quote: Column, folded: Column, empty: bool) -> Column:
    """Whether a quote is part of a sentence, or a sentence of the quote, blanks and case aside.

    ``folded``: array of folded sentences. ``empty`` is the answer for an empty quote.
    """
    needle = text.fold(quote)
    there = F.exists(folded, lambda h: (h != "") & (F.contains(h, needle) | F.contains(needle, h)))
    return F.when(needle == "", F.lit(empty)).otherwise(F.coalesce(there, F.lit(False)))


def verify(quotes: DataFrame, sources: DataFrame, key: str, quote_cols: list[str], empty: bool) -> DataFrame:
    """``quotes`` with ``verified``: all of ``quote_cols`` are supported by the ``sentences`` that ``sources`` has for the key.

    Sentences stay an array of the source's row, so the join is an equi-join and nothing is multiplied.
    """
    folded = sources.select(key, F.transform("sentences", text.fold).alias("_folded"))
    out = F.lit(True)
    for c in quote_cols:
        out = out & supported(F.col(c), F.col("_folded"), empty)
    return quotes.join(folded, key, "left").withColumn("verified", F.coalesce(out, F.lit(False))).drop("_folded")

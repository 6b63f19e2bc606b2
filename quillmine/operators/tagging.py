"""Tagging with many terms: one pass of an Aho-Corasick automaton over each sentence, however many terms there are.

Spark splits and folds the sentences, the automaton runs over Arrow batches, and what comes back is an opaque column: sentences are tagged once,
whatever reads the tags. A document's repeated sentences are found in the same pass, by a set of their folded forms, in linear time.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.lexicon import Lexicon

_HIT = "struct<pos:int,sentence:string,key:string,fresh:boolean,tags:map<string,array<string>>>"
_HIT_TYPE = pa.list_(pa.struct([("pos", pa.int32()), ("sentence", pa.string()), ("key", pa.string()), ("fresh", pa.bool_()), ("tags", pa.map_(pa.string(), pa.list_(pa.string())))]))


class Matcher:
    """The terms of a lexicon that a folded text contains, by category, categories and terms in the lexicon's order.

    A term matches anywhere, without regard to case; a ``*`` at its end marks a stem and changes nothing.
    """

    def __init__(self, lexicon: Lexicon):
        self.terms = [(category, term) for category, terms in lexicon.items() for term in terms]
        self.always: list[int] = []
        self.automaton = ahocorasick.Automaton()
        by_text: dict[str, list[int]] = {}
        for i, (_, term) in enumerate(self.terms):
            bare = term.lower().rstrip("*")
            if bare:
                by_text.setdefault(bare, []).append(i)
            else:
                self.always.append(i)
        for bare, found in by_text.items():
            self.automaton.add_word(bare, found)
        if by_text:
            self.automaton.make_automaton()
            self.find = self.automaton.iter
        else:
            self.find = lambda _: ()

    def tags(self, folded: str) -> dict[str, list[str]]:
        found = set(self.always)
        for _, numbers in self.find(folded):
            found.update(numbers)
        out: dict[str, list[str]] = {}
        for i in sorted(found):
            category, term = self.terms[i]
            out.setdefault(category, []).append(term)
        return out


def tagged_documents(docs: DataFrame, words: Lexicon, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """``id, n_sentences, hit`` and ``more`` (made of the array column ``sentences``) for every row of ``docs``.

    ``hit``: the sentences that hold a term, in order, as structs of place, sentence, folded form (``key``), whether no earlier one has that form (``fresh``), and
    ``tags``, a map of category to terms. A null text has no sentence. Rows are handled one by one.
    """
    split = docs.select(F.col(id_col).alias("_id"), text.sentences(F.col(text_col)).alias("sentences"))
    folded = split.select("_id", "sentences", F.transform("sentences", lambda s: F.lower(F.trim(s))).alias("folded"), *(c.alias(n) for n, c in more.items()))
    names = list(more)
    shared = docs.sparkSession.sparkContext.broadcast({c: list(terms) for c, terms in words.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            sentences, keys = batch.column(1), batch.column(2)
            hits = []
            for row in range(batch.num_rows):
                own, seen, found = keys[row].as_py() or [], set(), []
                for pos, key in enumerate(own):
                    if tags := matcher.tags(key):
                        found.append({"pos": pos, "sentence": sentences[row][pos].as_py(), "key": key, "fresh": key not in seen, "tags": list(tags.items())})
                        seen.add(key)
                hits.append(found)
            sizes = pa.array([len(s or ()) for s in sentences], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(hits, _HIT_TYPE), *batch.columns[3:]], ["_id", "n_sentences", "hit", *names])

    kinds = dict(folded.dtypes)
    schema = f"_id {kinds['_id']}, n_sentences int, hit array<{_HIT}>" + "".join(f", {n} {kinds[n]}" for n in names)
    return folded.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def term_hits(docs: DataFrame, words: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, pos, category, terms``: a row for each sentence and category with a term in it."""
    rows = tagged_documents(docs, words, id_col, text_col).select(id_col, F.explode("hit").alias("h"))
    return rows.select(id_col, F.col("h.pos").alias("pos"), F.explode("h.tags").alias("category", "terms"))

"""Ranked lexical search by scanning the documents' texts.

The terms of all items form one Aho-Corasick automaton, each guarded by a space on both sides, so that
only whole terms occur. Two scans of the texts use it, and nothing is stored per document: the first
gathers the statistics of the corpus, the second scores every document against every item whose terms
it holds and keeps the best of each item per task.

The items are cut into slices of bounded size; each slice is broadcast and searched by scans of its own.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmlens.llm.common import SLICE_ROWS, arrow_map, binary_column, map_batches, stored
from firmlens.llm.words import word_parts

SLICE_BYTES = 1 << 20  # terms of items that one pair of scans looks for
TERM_COST = 16  # bytes that a term of an item counts besides its letters
CELLS = 1 << 21  # scores, or term weights, held at once
DOCS, TERMS = -1, -2  # places of N and L among the counts of terms

_STATE: dict[str, tuple] = {}


def automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    """Finds the numbers of whole terms; letters stand for bytes."""
    machine = ahocorasick.Automaton()
    for k, term in enumerate(terms):
        machine.add_word(f" {term.decode('latin-1')} ", k)
    machine.make_automaton()
    return machine


def count_terms(text: bytes | None, machine: ahocorasick.Automaton) -> tuple[int, Counter]:
    """Number of all terms of a text, and how often each term of the automaton occurs."""
    n, found = 0, Counter()
    for part in word_parts(text):
        n += len(part.split())
        found.update(map(itemgetter(1), machine.iter(f" {part.decode('latin-1')} ")))
    return n, found


class Best:
    """The ``k`` best documents of each item seen so far, by score, then by id (ids that are null last)."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, id is null, id

    def add(self, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)
        if not len(doc):
            return
        item, score, gone, own = (
            np.concatenate(x) for x in zip(self.rows, (item, scores[doc, item], missing[doc], ids[doc]))
        )
        order = np.lexsort((own, gone, -score, item))
        item, score, gone, own = (x[order] for x in (item, score, gone, own))
        first = np.flatnonzero(np.diff(item, prepend=-1))
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        last = place == self.k - 1
        self.least[item[last]] = score[last]
        self.rows = [x[place < self.k] for x in (item, score, gone, own)]


class Scorer:
    """Scores documents against the items of one slice, some documents at a time."""

    def __init__(self, starts: np.ndarray, items: np.ndarray, weights: np.ndarray, n_items: int, k: int):
        # the items of term t are items[starts[t] : starts[t + 1]]
        self.starts, self.items, self.weights, self.n_items = starts, items, weights, n_items
        self.best, self.pending, self.cells = Best(n_items, k), [], 0

    def add(self, missing: bool, own: int, found: Counter, length: int) -> None:
        terms = np.fromiter(found.keys(), np.int64, len(found))
        tf = np.fromiter(found.values(), np.int64, len(found))
        gain = self.weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * length))
        self.pending.append((missing, own, terms[gain > 0], gain[gain > 0]))
        self.cells += self.n_items + int((self.starts[terms + 1] - self.starts[terms]).sum())
        if self.cells > CELLS:
            self.settle()

    def settle(self) -> None:
        if not self.pending:
            return
        missing, own, terms, gains = zip(*self.pending)
        row = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        terms, gains = np.concatenate(terms), np.concatenate(gains)
        size = self.starts[terms + 1] - self.starts[terms]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.starts[terms], size)
        scores = np.zeros(len(own) * self.n_items, np.int64)
        np.add.at(scores, np.repeat(row, size) * self.n_items + self.items[at], np.repeat(gains, size))
        self.best.add(scores.reshape(len(own), self.n_items), np.array(missing, np.int64), np.array(own, np.int64))
        self.pending, self.cells = [], 0


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """Distinct ``(item, term)``; terms as bytes. Rows that repeat an item add to it, null ids are left out."""
    named = items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").cast("string").alias("text")).where("item IS NOT NULL")
    kind = named.schema["item"].dataType.simpleString()

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        place, terms = [], []
        for at, t in enumerate(binary_column(batch, "text")):
            own = {w for part in word_parts(t) for w in part.split()}
            place += [at] * len(own)
            terms += own
        return pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(place, pa.int64())), pa.array(terms, pa.binary())], names=["item", "term"])

    return arrow_map(named, rows, f"item {kind}, term binary").distinct()


def _machine(slice_) -> tuple[ahocorasick.Automaton, int]:
    """The automaton of a broadcast slice, built once per Python worker."""
    name, terms = slice_.value[:2]
    if name not in _STATE:
        _STATE.clear()
        _STATE[name] = (automaton(terms), len(terms))
    return _STATE[name]


def _statistics(texts: DataFrame, slice_) -> DataFrame:
    """``(term, n)``: documents that hold a term of the slice; at ``DOCS`` those with any term, at
    ``TERMS`` all terms. One row per task and term, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, size = _machine(slice_)
        held, docs, terms = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                for t in binary_column(batch.slice(at, SLICE_ROWS), "text"):
                    n, found = count_terms(t, machine)
                    held[list(found)] += 1
                    docs, terms = docs + (n > 0), terms + n
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([DOCS, TERMS, *some.tolist()], pa.int64()), pa.array([docs, terms, *held[some].tolist()], pa.int64())], names=["term", "n"]
        )

    return map_batches(texts.select("text"), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _scores(texts: DataFrame, slice_, post, kind: str, k: int) -> DataFrame:
    """The best documents of each item, per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, _ = _machine(slice_)
        names, starts, items, weights, n_docs, n_terms = post.value
        scorer = Scorer(starts, items, weights, len(names), k)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                for own, t in zip(part.column("id").to_pylist(), binary_column(part, "text")):
                    n, found = count_terms(t, machine)
                    if found:
                        scorer.add(own is None, own or 0, found, 100 - 50 + (50 * n * n_docs) // n_terms)
        scorer.settle()
        item, score, missing, own = scorer.best.rows
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(item)), pa.array(own, mask=missing.astype(bool)), pa.array(score)], names=["item", "id", "score"]
        )

    return map_batches(texts, run, f"item {kind}, id long, score long")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 50, text: str = "text", doc: str = "doc_id", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for each item: ``(item, rank, id, score)``.

    Terms are runs of digits, letters (A-Z lower-cased) and non-ASCII characters of the whole text. With N
    documents that have a term, L terms in all, df documents with a term: its weight is
    floor(1000 ln((2N + 2) / (2 df + 1))), a document of n terms has m = 50 + 50 n N div L, and its score sums
    weight * (10^9 tf div (1000 tf + 20 m)) over the item's different terms. Equal scores rank by id.

    Every row of ``docs`` is a document: rows that repeat an id are ranked each, those with a null id after
    others of the same score. Null or empty texts have no terms and don't count. Rows that repeat an item
    id add their terms to it; items with a null id or without terms give no rows, nor do empty tables.
    Ids of documents are integers; ids of items may be of any type that can be grouped.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{doc}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    pairs = stored(item_terms(items, item, item_text), "search_terms")
    total = pairs.agg(F.sum(F.octet_length("term") + TERM_COST)).first()[0] or 0
    slices = max(1, math.ceil(total / SLICE_BYTES))
    kind = pairs.schema["item"].dataType.simpleString()
    found = []
    for at in range(slices):
        own = pairs.where(F.pmod(F.xxhash64("item"), F.lit(slices)) == at).toArrow()  # one slice: whole items, of the bounded size
        if not len(own):
            continue
        terms = own.column("term").combine_chunks().dictionary_encode()
        names = own.column("item").combine_chunks().dictionary_encode()
        number = np.asarray(terms.indices)
        order = np.argsort(number, kind="stable")
        words = terms.dictionary.to_pylist()
        starts = np.searchsorted(number[order], np.arange(len(words) + 1))
        slice_ = spark.sparkContext.broadcast((uuid.uuid4().hex, words))
        counts = {r.term: r.n for r in _statistics(texts, slice_).collect()}  # one number per term of the slice
        n_docs, n_terms = counts.get(DOCS, 0), counts.get(TERMS, 0)
        if not n_terms:
            break
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(t, 0) + 1))) for t in range(len(words))], np.int64)
        post = spark.sparkContext.broadcast((names.dictionary, starts, np.asarray(names.indices)[order].astype(np.int64), weights, n_docs, n_terms))
        found.append(_scores(texts, slice_, post, kind, k))
    rows = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], f"item {kind}, id long, score long")
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("item", "rank", "id", "score")

"""Ranked lexical search without a document index: one automaton of all query terms reads the texts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import LOWER, UPPER, ordered_sums

#: A term is a run of ASCII digits, ASCII letters and characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Each byte as the scan sees it: A-Z lower-cased, anything between terms a guard.
GUARD = b" "
SEEN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else GUARD[0] for b in range(256))
#: Bytes of terms and postings in one automaton, bytes of text scanned at once, and candidates held before they are cut to k.
SLICE, PIECE, HELD = 2_000_000, 1 << 20, 100_000
#: Parts that an item's candidates are ranked in before they meet.
SALTS = 64


class Automaton:
    """Finds all terms of a slice in a text, each between guards, and the items of each term."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        # texts are read as bytes, one character a byte, so that terms are found in UTF-8 as it is
        keys = [t.encode().decode("latin-1") for t in terms]
        self.longest = max(map(len, keys), default=0)
        self.find = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, key in enumerate(keys):
            self.find.add_word(f" {key} ", i)
        self.find.make_automaton()

    def _pieces(self, data: bytes) -> Iterator[tuple[bytes, int]]:
        """Guarded stretches of a text and their numbers of terms; a run longer than any term is not searched."""
        start = 0
        while len(data) - start > PIECE:
            end = data.rfind(GUARD, start + 1, start + PIECE)
            if end < 0:
                end = data.find(GUARD, start + PIECE)
                if end - start - 1 > self.longest:
                    yield b"", 1
                    start = end
                    continue
            part = data[start : end + 1]
            yield part, len(part.split())
            start = end  # the guard belongs to both neighbours
        part = data[start:]
        yield part, len(part.split())

    def counts(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of all terms of a text, numbers of the known ones in it and how often each occurs."""
        n, found = 0, []
        for part, terms in self._pieces(GUARD + (text or "").encode().translate(SEEN) + GUARD):
            n += terms
            own = np.fromiter((i for _, i in self.find.iter(part.decode("latin-1"))), dtype=np.int64) if part else np.zeros(0, np.int64)
            found.append(np.unique(own, return_counts=True))
        if len(found) == 1:
            return n, *found[0]
        ids, place = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
        tf = np.zeros(len(ids), np.int64)
        np.add.at(tf, place, np.concatenate([f[1] for f in found]))
        return n, ids, tf


def item_terms(items: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """``item, term``: each item's terms once; rows of one id are one item, rows without an id none."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    terms = items.filter(F.col(id).isNotNull()).select(
        F.col(id).cast("string").alias("item"), F.explode(F.array_distinct(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0)))).alias("term")
    )
    return terms.distinct()


def _sliced(pairs: DataFrame) -> Iterator[list]:
    """Rows of ``item_terms`` in slices of whole items of about SLICE bytes; an item larger than that is a slice of its own."""
    sizes = pairs.groupBy("item").agg(F.sum(F.octet_length("term") + 16).alias("size"))
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
    if not total:
        return
    if total <= SLICE:
        yield pairs.collect()
        return
    placed = ordered_sums(sizes, [F.col("item")], F.col("size"), "_i", "start").select("item", F.floor(F.col("start") / SLICE).alias("slice"))
    for row in placed.select("slice").distinct().orderBy("slice").collect():
        yield pairs.join(placed.filter(F.col("slice") == row.slice), "item").select("item", "term").collect()


def _statistics(docs: DataFrame, shared) -> dict[int, int]:
    """Documents that hold each term; under -1 those with any term at all, under -2 the terms of all."""

    def run(batches):
        terms, *_ = shared.value
        automaton = Automaton(terms)
        held, with_terms, total = np.zeros(len(terms), np.int64), 0, 0
        for batch in batches:
            for text in batch.column(1):
                n, ids, _ = automaton.counts(text.as_py())
                held[ids] += 1
                with_terms += n > 0
                total += n
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1, -2], some])), pa.array(np.concatenate([[with_terms, total], held[some]]))], names=["term", "n"]
        )

    partial = docs.mapInArrow(run, "term long, n long")
    return {r.term: r.n for r in partial.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def _cut(held: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The k best candidates of each item: highest score, then least id, rows without an id last."""
    item, score, none, doc = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((doc, none, -score, item))
    item = item[order]
    new = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
    rank = np.arange(len(item)) - np.repeat(new, np.diff(np.append(new, len(item))))
    keep = order[rank < k]
    return [c[keep] for c in map(np.concatenate, zip(*held))]


def _scored(docs: DataFrame, shared, k: int) -> DataFrame:
    """``item, doc, score``: for each task and item the k best of its documents."""

    def run(batches):
        terms, items, starts, postings, weights, n_docs, n_terms = shared.value
        automaton = Automaton(terms)
        floor = np.ones(len(items), np.int64)  # a score above 0 is asked for
        held, size = [], 0
        none = np.zeros(0, bool)
        best = [np.zeros(0, np.int64), np.zeros(0, np.int64), none, np.zeros(0, np.int64)]
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, ids, tf = automaton.counts(text.as_py())
                if not len(ids):
                    continue
                m = 10 + 90 * n * n_docs // n_terms
                gain = weights[ids] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                many = starts[ids + 1] - starts[ids]
                at = np.repeat(starts[ids] - np.cumsum(many) + many, many) + np.arange(many.sum())
                scores = np.zeros(len(items), np.int64)
                np.add.at(scores, postings[at], np.repeat(gain, many))
                good = np.flatnonzero(scores >= floor)
                if len(good):
                    held.append([good, scores[good], np.full(len(good), doc is None), np.full(len(good), doc or 0)])
                    size += len(good)
                if size > HELD + k * len(items):
                    best = _cut([best, *held], k)
                    held, size = [], 0
                    # an item with k candidates takes no document below its last one
                    last = np.flatnonzero(np.concatenate([best[0][1:] != best[0][:-1], [True]]))
                    full = np.bincount(best[0], minlength=len(items))[best[0][last]] == k
                    floor[best[0][last[full]]] = best[1][last[full]]
        best = _cut([best, *held], k)
        names = pa.array(items, pa.string()).take(pa.array(best[0]))
        yield pa.RecordBatch.from_arrays([names, pa.array(best[3], mask=best[2]), pa.array(best[1])], names=["item", "doc", "score"])

    return docs.mapInArrow(run, "item string, doc long, score long")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's k highest-scoring documents with a score above 0.

    A term's weight is floor(1000 ln((2N+2)/(2df+1))), and a document's score the sum over the item's
    terms of weight * (10**9 tf div (1000 tf + 8m)) with m = 10 + 90 n N div L: N documents with terms,
    L terms in all, n in the document. Equal scores go by ascending id.

    All items' terms make one automaton whose size is bounded by SLICE; more items are taken in slices,
    each with two scans of the texts (one counts, one scores), and nothing of a document is stored.
    Texts are scanned whole, in pieces cut between terms. Null and empty texts have no terms; repeated
    rows are documents of their own; a document without an id counts and ranks after those with one.
    Items of one id are one item, without an id or terms none. Document ids must be whole numbers. Only
    the named columns are read.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    found = []
    for rows in _sliced(item_terms(items, item_id, item_text)):
        names = sorted({r.item for r in rows})
        terms = sorted({r.term for r in rows})
        term_of, item_of = ({x: i for i, x in enumerate(own)} for own in (terms, names))
        pairs = np.array(sorted((term_of[r.term], item_of[r.item]) for r in rows), dtype=np.int64)
        starts = np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1))
        known = (terms, names, starts, pairs[:, 1].copy())
        counted = _statistics(read, spark.sparkContext.broadcast(known))
        n_docs, n_terms = counted.get(-1, 0), counted.get(-2, 0)
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counted.get(i, 0) + 1))) for i in range(len(terms))], dtype=np.int64)
        if n_terms:
            found.append(_scored(read, spark.sparkContext.broadcast((*known, weights, n_docs, n_terms)), k))
    kind = items.schema[item_id].dataType
    if not found:
        return spark.createDataFrame([], "item string, rank int, doc long, score long").select(
            F.col("item").cast(kind).alias(item_id), "rank", F.col("doc").alias(doc_id), "score"
        )
    rows = found[0]
    for more in found[1:]:
        rows = rows.union(more)
    # every task sends k rows an item: they are ranked in parts first, so that no item's rows meet in one task
    best = [F.desc("score"), F.asc_nulls_last("doc")]
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))
    for keys in (["item", "salt"], ["item"]):
        rows = rows.withColumn("rank", F.row_number().over(W.Window.partitionBy(*keys).orderBy(*best))).filter(F.col("rank") <= k)
    return rows.select(F.col("item").cast(kind).alias(item_id), "rank", F.col("doc").alias(doc_id), "score")

"""Ranked lexical search by range maxima over posting lists (operator 12).

Terms are runs of ASCII letters, digits and all characters from U+0080 on, with A-Z lowered.
A term t has the weight floor(1000 ln((2N + 2) / (2 df + 1))); a document that holds it tf
times gets weight * ((10^9 tf) div (1000 tf + 12 m)) from it, its impact, where m = 75 +
(25 n N) div L. The score of a document sums the impacts of an item's terms, with repeats.

Documents are read once: each task writes them as numbers and counts of the terms that the
items hold, with its share of N, L and df. The second pass takes them in blocks of bounded
size. A block has one posting list per term, in the order of the documents, and a sparse table
over its impacts, which answers where the largest one of any range is. An interval of
documents cannot hold a better score than the sum of its range maxima. The search opens the
intervals with the best bounds first: the document with the largest impact in it is scored
exactly and splits the interval in two. Intervals whose bound is below the k-th score found so
far are dropped, and so are those that could only tie with it by greater keys. The best k of an
item carry over from block to block of a task; Spark ranks those of all tasks.

Items are dealt into rounds of about ``ROUND_TERMS`` terms, so what a task holds of them does
not grow with their number. Null texts and texts without a term are no documents here and count
in no statistic. Repeated documents are all ranked, repeated items are items of their own;
equal scores by ascending key, null last. An empty table gives an empty result. Of further
columns none is read.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import fields_of, stored, texts

# fixed values: letters and digits of ASCII; every byte from 0x80 on belongs to a term, too
TERM_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz"
UNIT, SATURATION, LENGTH_PART, FLAT_PART = 1_000_000_000, 12, 25, 75
ROUND_TERMS = 1_000_000
BLOCK_POSTINGS = 400_000
FRONTIER = 4_000_000  # posting ranges that the open intervals of a block may hold
OPEN = 30_000  # posting ranges that are opened at once

LOWERED = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or c in TERM_BYTES else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(LOWERED).split()


def sortable(key) -> tuple:
    """Orders keys with null last."""
    return (key is None, key if key is not None else 0)


# --- posting lists of a block ----------------------------------------------------------

class Block:
    """Posting lists of some documents, in the order of their keys (null last), with sparse
    tables for the largest impact of a range (the first of equal ones)."""

    def __init__(self, keys: list, owner: np.ndarray, term: np.ndarray, impact: np.ndarray):
        order = sorted(range(len(keys)), key=lambda k: sortable(keys[k]))
        self.keys = [keys[k] for k in order]
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        self.size = len(keys)
        code = term.astype(np.int64) * self.size + place[owner]
        by = np.argsort(code, kind="stable")
        self.code, self.impact = code[by], impact[by]
        self.table = [np.arange(len(by), dtype=np.int32)]
        longest = int(np.bincount(term).max(initial=1))
        for level in range(1, longest.bit_length()):
            left = self.table[-1]
            right = np.append(left, left[-1:].repeat(1 << (level - 1)))[1 << (level - 1):]
            right = right[:len(left)]
            self.table.append(np.where(self.impact[right] > self.impact[left], right, left))
        self.table = np.stack(self.table)

    def range_maxima(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, value) of the largest impact of each range [start, end); value 0 if empty."""
        width = end - start
        some = width > 0
        level = LOG2.of(np.maximum(width, 1))
        a = self.table[level, np.where(some, start, 0)]
        b = self.table[level, np.where(some, end - (1 << level), 0)]
        best = np.where(self.impact[b] > self.impact[a], b, a)
        return best, np.where(some, self.impact[best], 0)

    def best(self, terms: np.ndarray, repeats: np.ndarray, k: int, held: Best) -> None:
        """Adds the documents that belong to the best ``k`` to ``held``."""
        n_terms = len(terms)
        start = np.searchsorted(self.code, terms * self.size)
        end = np.searchsorted(self.code, (terms + 1) * self.size)
        there = end > start
        terms, repeats, start, end = terms[there], repeats[there], start[there], end[there]
        if not len(terms):
            return
        # few intervals at first, while the score to beat is still rising
        most = max(1, OPEN // n_terms)
        step = min(k, most)
        base = terms * self.size
        # open intervals: first document, bound, splitting document, ranges of postings
        front = self._bounded(np.zeros(1, np.int64), start[None], end[None], repeats)
        while len(front[0]):
            first, bound, split, start, end = front
            floor, last = held.floor(k)
            useful = bound > floor
            # a tie counts only where the interval begins before the last key that is kept
            for tie in np.flatnonzero(bound == floor).tolist():
                useful[tie] = sortable(self.keys[first[tie]]) < last
            if not useful.all():
                first, bound, split, start, end = front = tuple(c[useful] for c in front)
            rest = None
            if len(bound) > step:
                chosen = np.zeros(len(bound), bool)
                chosen[np.lexsort((first, -bound))[:step]] = True
                rest = tuple(c[~chosen] for c in front)
                first, bound, split, start, end = (c[chosen] for c in front)
            step = min(2 * step, most)
            at = np.searchsorted(self.code, base[None] + split[:, None])
            hit = at < end
            hit &= self.code[np.minimum(at, len(self.code) - 1)] == base[None] + split[:, None]
            score = np.where(hit, self.impact[np.minimum(at, len(self.code) - 1)], 0) @ repeats
            held.add(score, [self.keys[d] for d in split.tolist()], k)
            left = self._bounded(first, start, np.minimum(at, end), repeats)
            right = self._bounded(split + 1, np.maximum(at + hit, start), end, repeats)
            parts = [left, right] + ([rest] if rest is not None else [])
            front = tuple(np.concatenate(c) for c in zip(*parts, strict=True))

    def _bounded(self, first, start, end, repeats):
        """Intervals that still hold postings, with their bounds and splitting documents."""
        place, value = self.range_maxima(start, end)
        value = value * repeats
        bound = value.sum(1)
        strongest = place[np.arange(len(place)), value.argmax(1)]
        some = bound > 0
        return (first[some], bound[some], self.code[strongest[some]] % self.size, start[some],
                end[some])


class Log2:
    """floor(log2) of small positive integers by a table that grows as needed."""

    def __init__(self):
        self.known = np.zeros(2, np.int64)

    def of(self, values: np.ndarray) -> np.ndarray:
        most = int(values.max(initial=1))
        if most >= len(self.known):
            self.known = np.frexp(np.arange(2 * most, dtype=float))[1].astype(np.int64) - 1
        return self.known[values]


LOG2 = Log2()


class Best:
    """The best scores of an item so far, ties by ascending key."""

    def __init__(self):
        self.rows: list[tuple] = []  # (-score, key is null, key)

    def add(self, scores: np.ndarray, keys: list, k: int) -> None:
        floor = -self.rows[-1][0] if len(self.rows) >= k else 1
        for i in np.flatnonzero(scores >= floor).tolist():
            self.rows.append((-int(scores[i]), *sortable(keys[i])))
        self.rows.sort()
        del self.rows[k:]

    def floor(self, k: int) -> tuple[int, tuple]:
        """The score and key to beat."""
        if len(self.rows) < k:
            return 0, (True, 0)
        score, null, key = self.rows[-1]
        return -score, (null, key)


# --- passes over the tables ------------------------------------------------------------

@dataclass(frozen=True)
class Items:
    """The items of a round: terms in order of their numbers; per item (number, repeats)."""

    terms: dict[bytes, int]
    numbers: list[int]
    held: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list[tuple[int, list[bytes]]]) -> Items:
        terms: dict[bytes, int] = {}
        held = []
        for _, found in rows:
            counts = Counter(found)
            held.append((np.array([terms.setdefault(t, len(terms)) for t in counts], np.int64),
                         np.array(list(counts.values()), np.int64)))
        return cls(terms, [n for n, _ in rows], held)


COUNTS = "n long, terms array<int>, counts array<long>, documents long"


def count_terms(docs: DataFrame, items: Items, key: str, text: str) -> DataFrame:
    """Documents with the items' terms (key, n, terms, counts); and one row per task with its
    number of documents, the sum of their n and the documents of each term."""
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = StructType([given.schema.fields[0], *fields_of(COUNTS)])
    vocabulary = items.terms

    def count(batches):
        documents, total, df, kind = 0, 0, np.zeros(len(vocabulary), np.int64), pa.null()
        for batch in batches:
            kind = batch.column(0).type
            used, ns, found, counts = [], [], [], []
            for k, raw in enumerate(texts(batch.column(1))):
                words = terms_of(raw)
                if not words:
                    continue
                documents += 1
                total += len(words)
                held = Counter(words)
                some = held.keys() & vocabulary.keys()
                if some:
                    used.append(k)
                    ns.append(len(words))
                    found.append([vocabulary[t] for t in some])
                    counts.append([held[t] for t in some])
                    df[found[-1]] += 1
            yield rows(batch.column(0).take(pa.array(used, pa.int64())), ns, found, counts,
                       pa.nulls(len(ns), pa.int64()))
        if documents:
            some = np.flatnonzero(df)
            yield rows(pa.nulls(1, kind), [total], [some], [df[some]], pa.array([documents]))

    def rows(keys, ns, found, counts, documents):
        return pa.RecordBatch.from_arrays(
            [keys, pa.array(ns, pa.int64()), pa.array(found, pa.list_(pa.int32())),
             pa.array(counts, pa.list_(pa.int64())), documents], schema.names)

    return stored(given.mapInArrow(count, schema))


@dataclass(frozen=True)
class Statistics:
    documents: int  # N
    terms: int  # L
    weights: np.ndarray

    @classmethod
    def of(cls, counted: DataFrame, n_terms: int) -> Statistics:
        shares = counted.where(F.col("documents").isNotNull())
        whole = shares.agg(F.sum("documents").alias("n"), F.sum("n").alias("l")).first()
        both = F.explode(F.arrays_zip("terms", "counts")).alias("at")
        df = dict(shares.select(both).groupBy("at.terms").agg(F.sum("at.counts")).collect())
        n = whole["n"] or 0
        weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(t, 0) + 1)))
                   for t in range(n_terms)]
        return cls(n, whole["l"] or 0, np.array(weights, np.int64))

    def length_norm(self, n: int) -> int:
        return FLAT_PART + LENGTH_PART * n * self.documents // self.terms


def search_counted(counted: DataFrame, items: Items, statistics: Statistics, k: int) -> DataFrame:
    """The best ``k`` of each item in each task: item long, key, score."""
    found = counted.where(F.col("documents").isNull()).select("key", "n", "terms", "counts")
    schema = StructType([*fields_of("item long"), found.schema.fields[0],
                         *fields_of("score long")])
    widest = max((len(t) for t, _ in items.held), default=1)
    most = max(64, FRONTIER // max(1, widest))

    def search(batches):
        best = [Best() for _ in items.held]
        keys, ns, widths, terms, counts, postings, kind = [], [], [], [], [], 0, pa.null()

        def close():
            owner = np.repeat(np.arange(len(keys)), np.concatenate(widths))
            tf = np.concatenate(counts)
            norm = np.array([statistics.length_norm(n) for n in ns], np.int64)[owner]
            term = np.concatenate(terms)
            impact = UNIT * tf // (1000 * tf + SATURATION * norm) * statistics.weights[term]
            block = Block(keys, owner, term, impact)
            for (wanted, repeats), held in zip(items.held, best, strict=True):
                block.best(wanted, repeats, k, held)

        for whole in batches:
            kind = whole.column(0).type
            step = max(1, min(most, BLOCK_POSTINGS // 100))
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                keys += batch.column(0).to_pylist()
                ns += batch.column(1).to_pylist()
                lists = batch.column(2)
                widths.append(lists.value_lengths().to_numpy())
                terms.append(lists.flatten().to_numpy())
                counts.append(batch.column(3).flatten().to_numpy())
                postings += len(terms[-1])
                if postings >= BLOCK_POSTINGS or len(keys) >= most:
                    close()
                    keys, ns, widths, terms, counts, postings = [], [], [], [], [], 0
        if keys:
            close()
        rows = [(number, key if not null else None, -score)
                for number, held in zip(items.numbers, best, strict=True)
                for score, null, key in held.rows]
        if rows:
            number, key, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int64()), pa.array(key, kind), pa.array(score, pa.int64())],
                schema.names)

    return found.mapInArrow(search, schema)


def read_items(items: DataFrame, key: str, text: str) -> DataFrame:
    """Items with a number of their own and their terms."""
    given = items.select(F.monotonically_increasing_id().alias("item"), F.col(key).alias("item_key"),
                         F.col(text).alias("text"))
    schema = StructType([*given.schema.fields[:-1], *fields_of("terms array<binary>")])

    def split(batches):
        for batch in batches:
            found = [terms_of(t) for t in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(found, pa.list_(pa.binary()))], schema.names)

    return stored(given.mapInArrow(split, schema))


def search(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id",
           text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank from 1, doc_id and score of the best ``k`` documents of every item."""
    held = read_items(items, item_key, item_text)
    total = held.agg(F.sum(F.size("terms"))).first()[0] or 0
    rounds = max(1, math.ceil(total / ROUND_TERMS))
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    out = None
    for r in range(rounds):
        own = held.where(F.pmod(F.xxhash64("item"), F.lit(rounds)) == r)
        # about ROUND_TERMS terms
        batch = Items.of([(i, [bytes(t) for t in terms])
                          for i, terms in own.select("item", "terms").collect()])
        counted = count_terms(docs, batch, key, text)
        statistics = Statistics.of(counted, len(batch.terms))
        found = (search_counted(counted, batch, statistics, k)
                 .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k))
        found = found.join(own.select("item", "item_key"), "item").select(
            F.col("item_key").alias(item_key), "rank", F.col("key").alias(key), "score")
        out = found if out is None else out.unionByName(found)
    return out

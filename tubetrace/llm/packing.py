"""Best-fit packing of token sequences with a fixed number of open bins (operator 8).

A document's tokens are the ids of its text and one closing id. Only what is longer than a
sequence is cut. Pieces are dealt evenly over partitions by a hash of their content and
packed there one after the other, in hash order, by a bounded-space online rule:

* the open bins are found through a bitset keyed by free space: the lowest set bit at or
  above the length of a piece is the best fit;
* if no open bin fits, a new one opens; if that would exceed ``open_bins``, the fullest open
  bin closes first.

A partition therefore holds ``open_bins`` bins and one batch, whatever the input. Null and
empty texts give one piece, the closing id alone. Repeated rows are pieces of their own. An
empty table gives an empty one. Of further columns only ``carry`` is kept.
"""

from __future__ import annotations

import zlib
from array import array
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import byte_letters
from .common import Recent, fields_of, portions

# documents a partition gets on average: few partitions leave few unfilled last bins, and
# packing 100,000 pieces takes less than a second
DOCS_PER_PARTITION = 50_000
OPEN_BINS = 1024  # far fewer than the pieces of a partition
REMEMBERED = 300_000  # runs of which a worker keeps the ids, besides those of one batch
# fixed value: letters whose lower case is one letter and which no normalization joins, and
# ASCII marks after them; as nothing follows, the marks are one pretoken
PLAIN_WORD = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-/:-@\[-`{-~]*)$"


class WordIds:
    """Ids of texts under a vocabulary that drops white space and lower-cases, so that each
    run between ASCII white space can be encoded on its own. Arrow cuts a batch into runs and
    numbers the distinct ones; the ids of recent runs are kept as one list array, out of which
    those of the texts are taken.

    A word of plain letters, with marks after it, is two pretokens at most: its lower-cased
    letters go to the merges at once. Other runs go through the whole tokenizer.
    """

    def __init__(self, path: str, limit: int = REMEMBERED):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merge = self.tokenizer.model.tokenize
        shown = {b: letter for letter, b in byte_letters().items()}
        self.shown = {c: "".join(shown[b] for b in chr(c).encode()) for c in range(128, 256)}
        self.limit, self.words = limit, Recent(self._word, limit)
        self.known = self.old = pa.array([], pa.string())  # runs of this span and the last one
        self.ids = self.old_ids = pa.array([], pa.list_(pa.uint32()))

    def _word(self, letters: str) -> bytes:
        if not letters.isascii():
            letters = letters.translate(self.shown)
        return array("I", [t.id for t in self.merge(letters)]).tobytes()

    def _encode(self, runs: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn(self, runs: pa.Array) -> pa.Array:
        """The ids of each of the ``runs``."""
        parts = pc.extract_regex(runs, PLAIN_WORD)
        letters = pc.utf8_lower(pc.struct_field(parts, "letters")).to_pylist()
        marks = pc.struct_field(parts, "marks").to_pylist()
        others = iter(self._encode(runs.filter(parts.is_null()).to_pylist()))
        words = self.words
        found = [next(others) if w is None else words[w] + words[m] if m else words[w]
                 for w, m in zip(letters, marks, strict=True)]
        ends = np.cumsum([0, *map(len, found)]) // 4
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                        pa.array(np.frombuffer(b"".join(found), "<u4")))

    def __call__(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        cut = pc.ascii_split_whitespace(column.cast(pa.string()))
        runs = cut.values.dictionary_encode()
        distinct = runs.dictionary
        place = pc.index_in(distinct, pa.concat_arrays([self.known, self.old]))
        new = distinct.filter(place.is_null())
        held = len(self.known) + len(self.old)
        place = place.fill_null(-1).to_numpy().copy()
        place[place < 0] = held + np.arange(len(new))
        ids = pa.concat_arrays([self.ids, self.old_ids, self._learn(new)]).take(pa.array(place))
        add = pa.array(place >= len(self.known))
        self.known = pa.concat_arrays([self.known, distinct.filter(add)])
        self.ids = pa.concat_arrays([self.ids, ids.filter(add)])
        if len(self.known) > self.limit:
            self.old, self.old_ids = self.known, self.ids
            self.known, self.ids = self.known[:0], self.ids[:0]
        coded = ids.take(runs.indices)
        flat, ends = coded.values.to_numpy(), coded.offsets.to_numpy()[cut.offsets.to_numpy()]
        return [flat[a:b].tobytes() for a, b in pairwise(ends.tolist())]


@lru_cache(maxsize=2)
def word_ids(path: str, limit: int = REMEMBERED) -> WordIds:
    return WordIds(path, limit)


class BestFit:
    """Bounded-space best fit: ``place`` gives the bin of a piece and its offset there."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.free = 0  # bit f is set while an open bin has f free places
        self.bins: dict[int, list[int]] = {}  # free places: bins
        self.n_open = self.n_bins = 0

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        found = stack.pop()
        if not stack:
            self.free &= ~(1 << free)
        self.n_open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.free >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            found = self._take(free)
        else:
            if self.n_open >= self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            free, found = self.capacity, self.n_bins
            self.n_bins += 1
        left = free - length
        if left:
            self.bins.setdefault(left, []).append(found)
            self.free |= 1 << left
            self.n_open += 1
        return found, self.capacity - free


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 0, text: str = "text",
           carry: tuple[str, ...] = ("doc_id",), with_ids: bool = False,
           remembered: int = REMEMBERED) -> DataFrame:
    """Rows (carry, piece, start, length, ids_crc32[, ids]), one per piece of a document."""
    kept = docs.select(*carry, F.col(text).alias("__text"))
    schema = docs.select(*carry).schema
    more = "piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    for field in fields_of(more):
        schema = schema.add(field)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode = word_ids(path, remembered)
        for whole in batches:
            for at, size in portions(whole.column(len(carry))):
                batch = whole.slice(at, size)
                rows, source = [], []
                coded = encode(batch.column(len(carry)).fill_null(""))
                for k, ids in enumerate(coded):
                    ids += end
                    n = len(ids) // 4
                    for piece, start in enumerate(range(0, n, capacity)):
                        part = ids[4 * start:4 * (start + capacity)]
                        rows.append((piece, start, len(part) // 4, zlib.crc32(part), part))
                        source.append(k)
                take = pa.array(source, pa.int64())
                made = [batch.column(c).take(take) for c in range(len(carry))]
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                made += [pa.array([r[c] for r in rows], kinds[c]) for c in range(4 + with_ids)]
                yield pa.RecordBatch.from_arrays(made, schema.names)

    return kept.mapInArrow(run, schema)


def pack(items: DataFrame, partitions: int, capacity: int = 2048, open_bins: int = OPEN_BINS,
         length: str = "length") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to items of at most ``capacity`` places each."""
    names = items.columns
    order = F.xxhash64(*names)
    dealt = (items.withColumn("__order", order).repartition(partitions, "__order")
             .sortWithinPartitions("__order", *names))
    schema = items.schema
    for field in fields_of("sequence_id long, offset long"):
        schema = schema.add(field)

    def run(batches):
        bins = BestFit(capacity, open_bins)
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(names.index(length)).to_pylist()]
            columns = [batch.column(c) for c in range(len(names))]
            columns += [pa.array([first + b for b, _ in placed], pa.int64()),
                        pa.array([o for _, o in placed], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return dealt.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0,
                   open_bins: int = OPEN_BINS, text: str = "text",
                   carry: tuple[str, ...] = ("doc_id",), with_ids: bool = False,
                   remembered: int = REMEMBERED) -> DataFrame:
    """Tokenizes, cuts and packs whole documents into sequences of ``capacity`` tokens."""
    partitions = max(1, -(-docs.count() // DOCS_PER_PARTITION))
    return pack(pieces(docs, path, capacity, end_id, text, carry, with_ids, remembered), partitions,
                capacity, open_bins)

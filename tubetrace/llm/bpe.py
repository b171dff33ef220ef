"""Byte-level BPE with forced cuts (operator 1).

A merge can only ever join two bytes that stand side by side inside some vocabulary token. So
where two neighbouring bytes of a pretoken occur in no token together, the encoding has a
boundary for certain. Every pretoken is cut there, each fragment is encoded on its own, and
the ids are concatenated: the same ids as encoding the pretoken at once, but long runs fall
into short fragments that repeat and can be remembered.

Nulls encode as the empty text (no ids, decoded to the empty text). Texts may be of any
length: a fragment costs O(n log n). Rows are independent, so repeated rows give equal rows
and an empty table an empty one. Of further columns only ``carry`` is kept.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import Recent, fields_of

# fixed value: the pattern byte-level BPE splits texts with before merging
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
            r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary files: printable bytes for themselves,
    the others, in order, for the code points from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1),
             *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


Coded = tuple[str, bytes]


class ForcedCutBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str, cache: int = 300_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = lambda token: bytes(letters[ch] for ch in token)
        by_text = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.token = {i: raw(t) for t, i in by_text.items()}
        self.byte_id = {b[0]: i for i, b in self.token.items() if len(b) == 1}
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []  # id that the merge of each rank makes
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[by_text[left], by_text[right]] = rank
            self.merged.append(by_text[left + right])
        self.joined = np.zeros((256, 256), bool)
        for b in self.token.values():
            pair = np.frombuffer(b, np.uint8)
            self.joined[pair[:-1], pair[1:]] = True
        self.joinable = {bytes((x, y)) for x, y in zip(*np.nonzero(self.joined), strict=True)}
        self.special = special
        self.cut_special = (regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")")
            if special else None)
        self.pretokens = regex.compile(PRETOKEN).findall
        self.fragment_ids = Recent(self.merge_bytes, cache)
        self.pretoken_ids = Recent(self._pretoken_ids, cache)
        self.chunk = Recent(self._chunk, cache)
        known = self.token | {i: s.encode() for s, i in special.items()}
        lengths = [len(known.get(i, b"")) for i in range(max(known) + 1)]
        self.token_length = np.array(lengths, np.int64)
        self.token_start = np.concatenate([[0], np.cumsum(self.token_length)[:-1]])
        self.token_bytes = np.frombuffer(
            b"".join(known.get(i, b"") for i in range(max(known) + 1)), np.uint8)

    def fragments(self, piece: bytes) -> list[bytes]:
        """``piece`` cut at every pair of bytes that no token holds side by side."""
        if len(piece) > 64:
            b = np.frombuffer(piece, np.uint8)
            cuts = (np.flatnonzero(~self.joined[b[:-1], b[1:]]) + 1).tolist()
        else:
            joinable = self.joinable
            cuts = [i + 1 for i in range(len(piece) - 1) if piece[i:i + 2] not in joinable]
        if not cuts:
            return [piece]
        return [piece[i:j] for i, j in zip([0, *cuts], [*cuts, len(piece)], strict=True)]

    def merge_bytes(self, fragment: bytes) -> tuple[int, ...]:
        """Applies the merge of lowest rank, leftmost first, until none is left."""
        ids = [self.byte_id[b] for b in fragment]
        if len(ids) > 48:
            return self._merge_long(ids)
        rank, none = self.rank.get, len(self.merged)
        ranks = [rank(pair, none) for pair in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            ids[i:i + 2] = [self.merged[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), none)
        return tuple(ids)

    def _merge_long(self, ids: list[int]) -> tuple[int, ...]:
        n, rank = len(ids), self.rank
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (r := rank.get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = self.merged[r], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return tuple(x for x in ids if x >= 0)

    def _pretoken_ids(self, pretoken: str) -> tuple[int, ...]:
        found: list[int] = []
        for f in self.fragments(pretoken.encode()):
            found += self.fragment_ids[f]
        return tuple(found)

    def _coded(self, text: str) -> Coded:
        ids: list[int] = []
        for pretoken in self.pretokens(text):
            ids += self.pretoken_ids[pretoken]
        return ",".join(map(str, ids)), np.array(ids, "<u4").tobytes()

    def _chunk(self, chunk: str) -> Coded | tuple[None, None]:
        """Code of a space and ``chunk``; none if the space after it is no certain cut."""
        return self._coded(" " + chunk) if self._cut_after(chunk) else (None, None)

    def _cut_after(self, chunk: str) -> bool:
        """Whether a space after ``chunk`` is cut off: no token joins the two bytes, and no
        run of white space goes on, so pretokens end there too."""
        return (bool(chunk) and not chunk[-1].isspace()
                and not self.joined[chunk[-1:].encode()[-1], 32])

    def _part(self, text: str) -> Coded:
        """Code of a text without special tokens, cut into chunks at its spaces if each of
        them is a certain cut."""
        first, *rest = text.split(" ")
        if rest and not self._cut_after(first):
            return self._coded(text)
        coded = [self._coded(first), *map(self.chunk.__getitem__, rest)]
        try:
            return ",".join([c[0] for c in coded if c[0] != ""]), b"".join([c[1] for c in coded])
        except TypeError:  # a chunk before a space that is no certain cut
            return self._coded(text)

    def code(self, text: str) -> Coded:
        """Ids of ``text``, in decimal joined by commas and as little-endian 32-bit numbers."""
        if self.cut_special is None or not any(s in text for s in self.special):
            return self._part(text)
        coded = [self._part(part) if k % 2 == 0 else
                 (str(self.special[part]), np.array([self.special[part]], "<u4").tobytes())
                 for k, part in enumerate(self.cut_special.split(text))]
        return ",".join([c[0] for c in coded if c[0]]), b"".join([c[1] for c in coded])

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.code(text or "")[1], "<u4").tolist()

    def decode(self, ids) -> str:
        """Text of ids (numbers, or their bytes); bytes that are no UTF-8 become U+FFFD."""
        ids = np.frombuffer(ids, "<u4") if isinstance(ids, bytes) else np.asarray(ids, np.int64)
        lengths = self.token_length[ids]
        ends = np.cumsum(lengths)
        at = np.repeat(self.token_start[ids] - ends + lengths, lengths)
        return self.token_bytes[at + np.arange(len(at))].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> ForcedCutBpe:
    """One codec per Python worker and vocabulary; its caches outlive a task."""
    return ForcedCutBpe(path)


def encode_documents(docs: DataFrame, path: str, text: str = "text",
                     carry: tuple[str, ...] = ("doc_id",), digest: bool = False) -> DataFrame:
    """Encodes and decodes every text. Adds ``ids`` (array of int) and ``decoded``; with
    ``digest`` n_tokens, ids_sha256 and decoded_sha256 instead."""
    kept = docs.select(*carry, F.col(text).alias("__text"))
    more = ("n_tokens long, ids_sha256 string, decoded_sha256 string" if digest
            else "ids array<int>, decoded string")
    schema = docs.select(*carry).schema
    for field in fields_of(more):
        schema = schema.add(field)

    def run(batches):
        bpe = codec(path)
        for batch in batches:
            columns = [batch.column(c) for c in range(batch.num_columns - 1)]
            rows = []
            for t in batch.column(batch.num_columns - 1).to_pylist():
                shown, ids = bpe.code(t or "")
                decoded = bpe.decode(ids)
                rows.append((len(ids) // 4, sha256(shown.encode()).hexdigest(),
                             sha256(decoded.encode()).hexdigest()) if digest
                            else (np.frombuffer(ids, "<u4").astype(np.int32), decoded))
            names = schema.names[len(columns):]
            types = [to_arrow_type(schema[n].dataType) for n in names]
            made = zip(*rows, strict=True) if rows else [[]] * len(names)
            columns += [pa.array(list(v), t) for v, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return kept.mapInArrow(run, schema)


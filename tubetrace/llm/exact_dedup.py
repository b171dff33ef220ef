"""Exact duplicates by skew-safe combining (operator 11).

Two texts are equal when they are identical without white space (space and 0x09-0x0D; null
counts as empty). Of equal texts, the row with the most code points in its original text
stays, then the one with the smallest key (null last), then the first one read.

Three stages, and each compares whole contents; a digest only says what to compare with:

* each task combines the rows it reads, in a table of at most ``LOCAL_BYTES`` of contents
  that is put out and begun anew when full;
* the contents that are left are merged by digest and salt, where a salt stands for ``FAN``
  neighbouring tasks, so a group of any size meets in pieces of that many tables;
* the winners of the salts are combined by digest.

A digest that a single table holds has nothing to be compared with: counts of digests, made
by salts as well, find those first, and their contents are not moved. Which contents are is
decided in place by 2^``SLOT_BITS`` bits, one for each hash of a shared digest: a bit that is set
by chance, or all of them if there are that many, costs a shuffle of a content and nothing
else. Rows are merged one after the other in the order of their digests, so a task holds the
contents of one digest at a time. Documents follow their winner by row numbers: their texts
are shuffled only as contents of tables, never once per row. Numbers are written to the
shared folder together with what they number, so a lost executor cannot mix two tries.

Repeated rows are rows of a group like others, and one of them stays. An empty table gives
an empty one. Of further columns only ``carry`` is kept, and none can clash.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import WORD_SPACE, fields_of, stored, texts

LOCAL_BYTES = 64 << 20  # contents that a task holds while it combines what it reads
FAN = 16  # tasks whose tables share a salt
SLOT_BITS = 24
ROW_BITS = 40  # a row number is the number of its task and its place there

# one row of each content that a table holds; the best row of those it stands for
ENTRY = "digest binary, id long, content binary, n long, points long, best long"


class Entry:
    """Equal rows seen so far: their content, number and best row."""

    __slots__ = ("best", "content", "id", "key", "n", "points")

    def __init__(self, id_: int, content: bytes):
        self.id, self.content, self.n, self.best = id_, content, 0, None

    def add(self, n: int, points: int, key, row: int) -> None:
        self.n += n
        if self.best is None or (
                (-points, key is None, key if key is not None else 0, row)
                < (-self.points, self.key is None, self.key if self.key is not None else 0,
                   self.best)):
            self.points, self.key, self.best = points, key, row


def equal_entry(entries: list[Entry], content: bytes, id_: int) -> Entry:
    """The entry with this very content, a new one if there is none."""
    for entry in entries:
        if entry.content == content:
            return entry
    entries.append(Entry(id_, content))
    return entries[-1]


def entry_columns(entries: list[tuple[bytes, Entry]], key_type: pa.DataType) -> dict[str, pa.Array]:
    found = [e for _, e in entries]
    return {"digest": pa.array([d for d, _ in entries], pa.binary()),
            "id": pa.array([e.id for e in found], pa.int64()),
            "content": pa.array([e.content for e in found], pa.binary()),
            "n": pa.array([e.n for e in found], pa.int64()),
            "points": pa.array([e.points for e in found], pa.int64()),
            "best": pa.array([e.best for e in found], pa.int64()),
            "best_key": pa.array([e.key for e in found], key_type)}


def full_batch(schema: StructType, columns: dict, rows: int) -> pa.RecordBatch:
    """A batch of all columns of ``schema``; those not given are null."""
    kinds = {"binary": pa.binary(), "bigint": pa.int64()}
    return pa.RecordBatch.from_arrays(
        [columns[f.name] if f.name in columns
         else pa.nulls(rows, kinds.get(f.dataType.simpleString(), pa.null()))
         for f in schema.fields], schema.names)


def _combine_read(docs: DataFrame, names: list[str], key: str, text: str, digest_bytes: int):
    """Rows of two kinds: documents with row, local and sha; entries of the tasks' tables."""
    given = docs.select(*(F.col(c).alias(f"in_{c}") for c in names), F.col(text).alias("__text"))
    key_field = StructField("best_key", docs.schema[key].dataType)
    schema = StructType([*given.schema.fields[:-1], *fields_of("row long, local long, sha binary"),
                         *fields_of(ENTRY), key_field])
    at_key = names.index(key)

    def combine(batches):
        row = TaskContext.get().partitionId() << ROW_BITS
        tables: dict[bytes, list[Entry]] = {}
        held, key_type, kinds = 0, None, None

        def entries():
            flat = [(d, e) for d, group in tables.items() for e in group]
            for at in range(0, len(flat), 1000):
                part = flat[at:at + 1000]
                columns = entry_columns(part, key_type)
                for name, kind in kinds.items():
                    columns[name] = pa.nulls(len(part), kind)
                yield full_batch(schema, columns, len(part))

        for batch in batches:
            if kinds is None:
                kinds = dict(zip(names_in, (c.type for c in batch.columns[:-1]), strict=True))
                key_type = batch.column(at_key).type
            points = pc.fill_null(pc.utf8_length(batch.column(len(names))), 0).to_pylist()
            keys = batch.column(at_key).to_pylist()
            local, shas = [], []
            for k, raw in enumerate(texts(batch.column(len(names)))):
                content = raw.translate(None, WORD_SPACE)
                sha = sha256(content).digest()
                entry = equal_entry(tables.setdefault(sha[:digest_bytes], []), content, row + k)
                if not entry.n:
                    held += len(content) + 200
                entry.add(1, points[k], keys[k], row + k)
                local.append(entry.id)
                shas.append(sha)
            columns = dict(zip(names_in, batch.columns[:-1], strict=True))
            columns |= {"row": pa.array(range(row, row + len(local)), pa.int64()),
                        "local": pa.array(local, pa.int64()), "sha": pa.array(shas, pa.binary()),
                        "best_key": pa.nulls(len(local), key_type)}
            yield full_batch(schema, columns, len(local))
            row += len(local)
            if held > LOCAL_BYTES:
                yield from entries()
                tables.clear()
                held = 0
        if tables:
            yield from entries()

    names_in = [f"in_{c}" for c in names]
    return stored(given.mapInArrow(combine, schema))


def _merge(entries: DataFrame, by: list[str], keep_content: bool) -> DataFrame:
    """Merges entries of equal content among those that agree ``by`` digest (and salt). Rows of
    two kinds: links from an entry (id) to the one that now stands for it (to), and these."""
    columns = ["digest", "id", "content", "n", "points", "best", "best_key"]
    key_field = entries.schema["best_key"]
    schema = StructType([*fields_of(ENTRY), key_field, StructField("to", LongType())])
    dealt = entries.repartition(*by).sortWithinPartitions(*by).select(*by, *columns[1:])
    width = len(by)

    def merge(batches):
        last, group = None, []
        for whole in batches:
            key_type = whole.schema.field("best_key").type
            done, ids, to = [], [], []
            held = [c.to_pylist() for c in whole.columns]
            for values in zip(*held, strict=True):
                place, (id_, content, n, points, best, key) = values[:width], values[width:]
                if place != last:
                    done += [(last[0], e) for e in group] if group else []
                    last, group = place, []
                entry = equal_entry(group, content, id_)
                entry.add(n, points, key, best)
                ids.append(id_)
                to.append(entry.id)
            yield full_batch(schema, {"id": pa.array(ids, pa.int64()), "to": pa.array(to, pa.int64()),
                                      "best_key": pa.nulls(len(ids), key_type)}, len(ids))
            yield winners(done, key_type)
        if group:
            yield winners([(last[0], e) for e in group], key_type)

    def winners(done, key_type):
        columns = entry_columns(done, key_type)
        if not keep_content:
            del columns["content"]
        return full_batch(schema, columns, len(done))

    return stored(dealt.mapInArrow(merge, schema))


def _perhaps_shared(entries: DataFrame, shared: DataFrame) -> DataFrame:
    """The entries whose digest has its bit among those of the ``shared`` digests."""
    slot = F.xxhash64("digest").bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(F.lit(63)).cast("int"))
    words = (shared.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word"))
             .agg(F.bit_or(bit).alias("bits")).toArrow())
    bits = np.zeros(1 << SLOT_BITS - 6, np.uint64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    common = entries.sparkSession.sparkContext.broadcast(bits)  # 2 MB, whatever the input
    columns = entries.columns

    def passing(batches):
        for batch in batches:
            slots = batch.column(len(columns)).to_numpy().astype(np.uint64)
            there = common.value[slots >> np.uint64(6)] >> (slots & np.uint64(63)) & np.uint64(1)
            yield batch.select(columns).filter(pa.array(there.astype(bool)))

    return entries.withColumn("slot", slot).mapInArrow(passing, entries.schema)


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text",
                carry: tuple[str, ...] = ("doc_id",), digest_bytes: int = 32) -> DataFrame:
    """``carry`` of every row with keep_id (key of the row that stays), group_size, kept and
    text_sha256 (of the content, hex). The result does not depend on ``digest_bytes``."""
    names = list(dict.fromkeys([*carry, key]))
    read = _combine_read(docs, names, key, text, digest_bytes)
    entry, link = F.col("digest").isNotNull(), F.col("to").isNotNull()
    own = [f.name for f in fields_of(ENTRY)]
    entries = read.where(entry).select(*own, "best_key").withColumn(
        "salt", F.shiftright("id", ROW_BITS + FAN.bit_length() - 1))
    shared = stored(entries.groupBy("digest", "salt").agg(F.count("*").alias("tables"))
                    .groupBy("digest").agg(F.sum("tables").alias("tables"))
                    .where("tables > 1").select("digest"))
    stays = [F.col("best_key").alias("keep_id"), F.col("n").alias("group_size"), "best"]
    alone = (entries.drop("content").join(shared, "digest", "left_anti")
             .select(F.col("id").alias("local"), *stays))
    salted = _merge(_perhaps_shared(entries, shared).join(shared, "digest", "left_semi"),
                    ["digest", "salt"], keep_content=True)
    combined = _merge(salted.where(entry), ["digest"], keep_content=False)
    classes = combined.where(entry).select(F.col("id").alias("class"), *stays)
    named = (salted.where(link).select(F.col("id").alias("local"), F.col("to").alias("id"))
             .join(combined.where(link).select("id", F.col("to").alias("class")), "id")
             .join(classes, "class").select("local", "keep_id", "group_size", "best")
             .unionByName(alone))
    rows = read.where(F.col("row").isNotNull()).select(
        *(f"in_{c}" for c in names), "row", "local", "sha")
    return (rows.join(named, "local")
            .select(*(F.col(f"in_{c}").alias(c) for c in carry), "keep_id", "group_size",
                    (F.col("row") == F.col("best")).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    numbered = docs.withColumnsRenamed({c: f"of_{c}" for c in docs.columns})
    rows = deduplicate(numbered, f"of_{key}", f"of_{text}", tuple(numbered.columns))
    return rows.where("kept").select(*(F.col(f"of_{c}").alias(c) for c in docs.columns))

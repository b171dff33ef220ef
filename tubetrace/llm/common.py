"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import ensure_checkpoint_dir, shared_folder, stored  # noqa: F401

# fixed values: the bytes that separate words, and the only letters that are lower-cased
WORD_SPACE = b" \t\n\x0b\x0c\r"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
TO_LOWER = bytes.maketrans(UPPER, LOWER)
BATCH_BYTES = 8_000_000  # text that Arrow cuts into words at once; a longer text goes alone


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def package_for_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, unless a path is
    set already. On a cluster without that folder, submit the package with --py-files."""
    home = str(Path(__file__).resolve().parent.parent.parent)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if home not in paths:
        environment["PYTHONPATH"] = ":".join([*paths, home])


def fold(column: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def checkpointed(df: DataFrame) -> DataFrame:
    """For the small tables of loops; the files go when nothing refers to them any more."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def hidden(docs: DataFrame) -> DataFrame:
    """The columns under names that an operator's own cannot clash with."""
    return docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns})


def shown(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` as they were before ``hidden``, and no others."""
    return rows.select(*(F.col(f"in_{c}").alias(c) for c in docs.columns))


def fields_of(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


def texts(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null is the empty text."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def portions(texts: pa.Array, size: int | None = None) -> list[tuple[int, int]]:
    """Neighbouring rows of about ``size`` bytes of text: their first row and their number."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(), dtype=np.int64)
    change = np.diff(ends // (size or BATCH_BYTES), prepend=-1)
    return [(a, b - a) for a, b in pairwise([*np.flatnonzero(change).tolist(), len(texts)])]


def sent(docs: DataFrame, carry: tuple[str, ...], text: str) -> tuple[DataFrame, int]:
    """The carried columns and the text, and the place of the text. A carried text is not sent
    twice."""
    if text in carry:
        return docs.select(*carry), carry.index(text)
    return docs.select(*carry, F.col(text).alias("__text")), len(carry)


def words(text: bytes) -> list[bytes]:
    """Runs of bytes other than space and 0x09-0x0D, in order (what bytes.split cuts at)."""
    return text.split()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b): rows (node, component), one
    per node that has an edge to another one; the component is its smallest node.

    Each round hooks every node to its smallest neighbour, follows two steps of pointers and
    contracts the edges, so at least half of the nodes with edges go. Only minima and joins
    on node ids are used; a hub is never gathered in one place. Null ends are ignored.
    """
    a, b = F.col("a"), F.col("b")
    edges = checkpointed(edges.where(a != b)
                         .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct())
    labels = checkpointed(edges.select(a.alias("node")).union(edges.select("b")).distinct()
                          .withColumn("component", F.col("node")))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hook = (both.groupBy("a").agg(F.min("b").alias("p"))
                .select(F.col("a").alias("n"), F.least("a", "p").alias("p")))
        hook = checkpointed(hook)
        step = hook.select(F.col("n").alias("p"), F.col("p").alias("q"))
        hook = checkpointed(hook.join(step, "p").select("n", F.col("q").alias("p")))
        labels = checkpointed(
            labels.join(hook.withColumnRenamed("n", "component"), "component", "left")
            .select("node", F.coalesce("p", "component").alias("component")))
        ends = (edges.join(hook.select(F.col("n").alias("a"), F.col("p").alias("x")), "a")
                .join(hook.select(F.col("n").alias("b"), F.col("p").alias("y")), "b"))
        edges = checkpointed(
            ends.where("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return labels


def chunk_pairs(rows: DataFrame, identity: str, count: str, size: int) -> DataFrame:
    """Splits the members of large groups for comparison: ``count`` (rows of the group) over
    ``size`` makes that many chunks, dealt by a hash of ``identity``; each pair of chunks
    (c1 <= c2) gets the rows of both, with their own chunk in ``c``."""
    parts = F.ceil(F.col(count) / F.lit(size)).cast("int")
    return (rows.withColumn("c", F.pmod(F.xxhash64(identity), parts).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
            .withColumns({"c1": F.least("c", "other"), "c2": F.greatest("c", "other")})
            .drop("other", count))


def sorted_runs(batches, keys: list[str]):
    """Runs of rows with equal ``keys`` out of record batches sorted by them, as tables."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change).tolist()
        first = tuple(c[0] for c in columns)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        at = 0
        for s in starts:
            held.append(batch.slice(at, s - at))
            yield pa.Table.from_batches(held)
            held, at = [], s
        held.append(batch.slice(at))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def matrix(column, dtype) -> np.ndarray:
    """Binary values of one length as the rows of a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype).reshape(len(values), -1)


class Recent(dict):
    """Results of ``make`` by key. Holds the entries used in the last two spans of ``limit``
    new keys, so memory is bounded and a frequent key is made once."""

    def __init__(self, make, limit: int = 300_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

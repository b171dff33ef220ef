"""Near-duplicate embeddings by randomised-rotation binary codes (operator 2).

Each distinct vector is turned by ``rotations`` random rotations; the signs of the turned
components are its code, and one correction factor per rotation, the inner product of the
unit vector with its own code, is kept beside it while it is compared. For a code and a second vector

    <code, turned second vector> / factor

is an unbiased estimate of the inner product. Its error has a standard deviation of at most
sqrt((1 - f^2) / f^2 / (dim - 1)) per rotation, and averaging over the rotations shrinks it.
A pair whose upper confidence bound (``SURE`` deviations) stays below the threshold is
dropped; every other pair is computed anew from the vectors, in double precision, and linked
only by that value.

Pairs are looked for among vectors that agree on a band of code bits. The bits of a band grow
with the logarithm of the number of vectors, so a bucket stays small, and there are as many
bands as keep the chance to miss a pair right at the threshold below ``MISS`` (pairs above
it are missed far less often). Buckets of more than ``HOT_ROWS`` rows are cut into
chunks, and pairs of chunks are compared in tasks of bounded size. A pair counts in the first
band it shares. Tasks put out link counts per vector and a spanning forest of the links they
found, never the pairs, so a large group of copies does not make a quadratic output.

Equal vectors are one class from the start. Vectors that are null, empty, zero or hold null
or non-finite components link with nothing; vectors of different length neither. Repeated
rows and ids that occur twice are vectors of their own. An empty table gives an empty one;
further columns are kept out unless in ``carry``.
"""

from __future__ import annotations

import math
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, chunk_pairs, components, fields_of, sorted_runs, stored

SURE, MISS = 4.0, 5e-4
CHUNK = 512
HOT_ROWS = 4096  # a bucket with more rows is cut


def plan_bands(n: int, threshold: float) -> tuple[int, int]:
    """Bits of a band and number of bands for ``n`` vectors."""
    agree = 1 - math.acos(threshold) / math.pi
    bits = min(28, max(6, math.ceil(math.log2(max(2, n))) - 4))
    return bits, math.ceil(math.log(MISS) / math.log1p(-agree ** bits))


@lru_cache(maxsize=8)
def turns(dim: int, count: int) -> np.ndarray:
    """``count`` random rotations beside each other (dim, count * dim)."""
    rng = np.random.default_rng(dim)
    made = []
    for _ in range(count):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        made.append(q * np.sign(np.diag(r)))
    return np.concatenate(made, axis=1).astype(np.float32)


def unit_vector(values: list | None) -> np.ndarray | None:
    if not values or any(v is None for v in values):
        return None
    v = np.array(values, np.float64)
    if not np.isfinite(v).all():
        return None
    top = np.abs(v).max()  # scaled first: squares of very large or small numbers are lost
    return None if top == 0 else (v / top) / np.linalg.norm(v / top)


def encode(units: np.ndarray, bits: int, bands: int):
    """(turned vectors, signs, correction factors) of unit vectors of one length."""
    dim = units.shape[1]
    count = -(-bits * bands // dim)
    turned = units.astype(np.float32) @ turns(dim, count)
    parts = turned.reshape(len(units), count, dim)
    factors = np.abs(parts).sum(2) / np.float32(math.sqrt(dim))
    return turned, turned > 0, factors


def band_keys(signs: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """Number of the bucket in each band (vectors, bands)."""
    cut = signs[:, :bits * bands].reshape(len(signs), bands, bits)
    return cut @ (1 << np.arange(bits, dtype=np.int64))


def estimates(turned, signs, factors, others):
    """Unbiased estimates of the inner products of the coded vectors with ``others`` (turned),
    and the standard deviation of each code's estimates."""
    n, count = factors.shape
    dim = turned.shape[1] // count
    weight = np.repeat(1 / (factors * np.float32(count * math.sqrt(dim))), dim, axis=1)
    value = np.where(signs, weight, -weight) @ others.T
    spread = (1 / factors ** 2 - 1).clip(0).mean(1) / max(1, dim - 1) / count
    return value, np.sqrt(spread)


class Forest:
    """Links that join two trees, of links seen one after the other."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def compare(ids, units, copies, chunk, band, c1, c2, bits, bands, threshold):
    """(class, other, links): link counts of the classes (other null), and links of a forest."""
    turned, signs, factors = encode(units, bits, bands)
    keys = band_keys(signs, bits, bands)
    left = np.flatnonzero(chunk == c1)
    right = left if c1 == c2 else np.flatnonzero(chunk == c2)
    links, forest, edges = np.zeros(len(ids), np.int64), Forest(len(ids)), []
    for at in range(0, len(left), CHUNK):
        rows = left[at:at + CHUNK]
        value, spread = estimates(turned[rows], signs[rows], factors[rows], turned[right])
        i, j = np.nonzero(value + SURE * spread[:, None] >= threshold)
        i, j = rows[i], right[j]
        ok = (i < j) if c1 == c2 else np.ones(len(i), bool)
        i, j = i[ok], j[ok]
        for part in range(0, len(i), 50_000):
            a, b = i[part:part + 50_000], j[part:part + 50_000]
            if band:
                first = ~(keys[a, :band] == keys[b, :band]).any(1)
                a, b = a[first], b[first]
            exact = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
            a, b = a[exact], b[exact]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            edges += [(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True)
                      if forest.join(x, y)]
    some = np.flatnonzero(links)
    return ([(ids[k], None, int(links[k])) for k in some]
            + [(ids[x], ids[y], 0) for x, y in edges])


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, key: str = "vec_id",
                    embedding: str = "embedding",
                    carry: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """Adds n_links, component_id (smallest key in reach) and kept (key = component_id)."""
    names = list(dict.fromkeys([*carry, key]))
    schema = vectors.select(*names).schema
    for field in fields_of("digest binary, vector binary"):
        schema = schema.add(field)
    n_names = len(names)

    def prepare(batches):
        for batch in batches:
            units = [unit_vector(v) for v in batch.column(n_names).to_pylist()]
            raw = [None if u is None else u.tobytes() for u in units]
            digests = [None if r is None else blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in range(n_names)]
                + [pa.array(digests, pa.binary()), pa.array(raw, pa.binary())], schema.names)

    base = stored(vectors.select(*names, F.col(embedding).alias("__embedding"))
                  .mapInArrow(prepare, schema))
    classes = stored(base.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min(key).alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector")))
    bits, bands = plan_bands(classes.count(), threshold)

    def cut(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                raw = batch.column(2).to_pylist()
                keys = [None] * len(raw)
                for size in {len(r) for r in raw}:
                    at_size = [k for k, r in enumerate(raw) if len(r) == size]
                    units = np.stack([np.frombuffer(raw[k], np.float64) for k in at_size])
                    found = band_keys(encode(units, bits, bands)[1], bits, bands)
                    # vectors of another length have buckets of their own
                    for k, row in zip(at_size, found + (size // 8 << 28), strict=True):
                        keys[k] = row
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(keys, pa.list_(pa.int64()))],
                    ["digest", "copies", "vector", "keys"])

    rows = (classes.select("digest", "copies", "vector")
            .mapInArrow(cut, "digest binary, copies long, vector binary, keys array<long>"))
    rows = stored(rows)
    band_rows = rows.select("digest", F.posexplode("keys").alias("band", "bucket"))
    # written, so that the engine knows its size when it chooses the join
    hot = stored(band_rows.groupBy("band", "bucket").agg(F.count("*").alias("n"))
                 .where(F.col("n") > HOT_ROWS))
    dealt = (rows.select("digest", "copies", "vector", F.posexplode("keys").alias("band", "bucket"))
             .join(hot, ["band", "bucket"], "left")
             .withColumn("n", F.coalesce("n", F.lit(1))))
    keys = ["band", "bucket", "c1", "c2"]
    dealt = (chunk_pairs(dealt, "digest", "n", CHUNK).repartition(*keys)
             .sortWithinPartitions(*keys))

    def link(batches):
        for table in sorted_runs(batches, keys):
            if len(table) < 2:
                continue
            band, bucket, c1, c2 = (table.column(k)[0].as_py() for k in keys)
            raw = table.column("vector").to_pylist()
            found = compare(table.column("digest").to_pylist(),
                            np.frombuffer(b"".join(raw)).reshape(len(raw), -1),
                            table.column("copies").to_numpy(), table.column("c").to_numpy(),
                            band, c1, c2, bits, bands, threshold)
            if found:
                a, b, n = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())],
                    ["a", "b", "n"])

    found = stored(dealt.mapInArrow(link, "a binary, b binary, n long"))
    counts = (found.where(F.col("b").isNull()).groupBy(F.col("a").alias("digest"))
              .agg(F.sum("n").alias("others")))
    groups = components(found.where(F.col("b").isNotNull()).select("a", "b"))
    named = (classes.drop("vector")
             .join(groups.withColumnRenamed("node", "digest"), "digest", "left"))
    lowest = (named.where(F.col("component").isNotNull()).groupBy("component")
              .agg(F.min("least").alias("lowest")))
    named = (named.join(lowest, "component", "left").join(counts, "digest", "left")
             .select("digest", F.coalesce("lowest", "least").alias("component_id"),
                     (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    return (base.drop("vector").join(checkpointed(named), "digest", "left")
            .withColumns({"component_id": F.coalesce("component_id", key),
                          "n_links": F.coalesce("n_links", F.lit(0))})
            .select(*carry, "n_links", "component_id",
                    F.col(key).eqNullSafe(F.col("component_id")).alias("kept")))

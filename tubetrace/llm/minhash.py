"""Near-duplicate documents by MinHash with sequential Bayesian verification (operator 5).

A document is the set of its distinct shingles of five words (A-Z lower-cased). Documents
with the same text are one class from the start, and only its digest goes on. Each class has
a signature of ``BANDS * ROWS`` minima; classes that agree on a band meet in a bucket.

In a bucket signatures are compared batch by batch. With m of n positions equal, the
similarity has a Beta(m + 1, n - m + 1) posterior; a pair is dropped as soon as the
probability that it reaches the threshold is below ``MISS``. What survives all batches is
verified on the full sets, exactly: 100 * common >= 85 * united.

Large buckets are cut into chunks, and pairs of chunks are compared in tasks of bounded size;
a pair is put out once, by the first band it shares. As groups are wanted, not pairs, the
first round puts out, for every class, the most similar partners per chunk only, and joins
what it confirms. The second round goes through the buckets that still hold more than one
group, with the full sets at hand, and verifies every surviving pair of different groups on
the spot; it puts out the links that join groups and no pairs. So no link that could join two
groups is left out, and a thousand near copies do not become half a million pairs.

Null texts and texts without words have the empty set and are linked with nothing. Texts of
fewer than five words are one shingle. Shingles and bands are compared by 64-bit hashes.
Repeated rows and ids that occur twice are documents of one class. A null id counts last. An
empty table gives an empty one; further columns are kept out unless in ``carry``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    TO_LOWER,
    Recent,
    checkpointed,
    chunk_pairs,
    components,
    fields_of,
    hidden,
    matrix,
    shown,
    sorted_runs,
    stored,
    texts,
)

SHINGLE = 5
BANDS, ROWS = 25, 5
SIZE = BANDS * ROWS
MISS = 1e-5
CHUNK = 1024
PARTNERS = 2  # of a class in the first round, for each chunk it meets; the second takes the rest

_rng = np.random.default_rng(20)
FACTORS = _rng.integers(0, 1 << 32, SIZE, np.uint64).astype(np.uint32) | np.uint32(1)
ADDENDS = _rng.integers(0, 1 << 32, SIZE, np.uint64).astype(np.uint32)
MIX = [np.uint64(x | 1) for x in _rng.integers(0, 1 << 63, SHINGLE).tolist()]


def word_hashes() -> Recent:
    return Recent(xxhash.xxh3_64_intdigest)


def shingles(text: bytes, hashes: Recent) -> np.ndarray:
    """Distinct shingles of a text as sorted 64-bit hashes."""
    found = text.translate(TO_LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=len(found))], np.uint64)
    h = np.array([hashes[w] for w in found], np.uint64)
    n = len(h) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        x = h[k:k + n] * MIX[k]
        total = (total ^ (x >> np.uint64(29)) ^ x) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(total ^ (total >> np.uint64(32)))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of every non-empty set under each of the hash functions."""
    folded = np.concatenate([(s ^ (s >> np.uint64(32))).astype(np.uint32) for s in sets])
    sizes = [len(s) for s in sets]
    starts = np.cumsum([0, *sizes[:-1]])
    out = np.empty((len(sets), SIZE), np.uint32)
    for k in range(SIZE):
        x = folded * FACTORS[k] + ADDENDS[k]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        out[:, k] = np.minimum.reduceat(x, starts)
    return out


def least_equal(threshold: float, miss: float = MISS) -> dict[int, int]:
    """For each number n of positions compared, the fewest equal ones with which the posterior
    probability of reaching ``threshold`` is still ``miss`` or more."""
    grid = (np.arange(20_000) + .5) / 20_000
    bounds = {}
    for n in range(ROWS * 5, SIZE + 1, ROWS * 5):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            p = np.exp(log - log.max())
            if p[grid >= threshold].sum() / p.sum() >= miss:
                bounds[n] = m
                break
    return bounds


def similar_enough(a: np.ndarray, b: np.ndarray, bounds: dict[int, int]):
    """Pairs of rows (i, j) that survive all batches of the signatures, with the number of
    equal positions; batches shrink the pairs step by step."""
    i, j = np.divmod(np.arange(len(a) * len(b)), len(b))
    equal = np.zeros(len(i), np.int32)
    done = 0
    for n, least in bounds.items():
        equal += (a[i, done:n] == b[j, done:n]).sum(1, dtype=np.int32)
        keep = equal >= least
        i, j, equal, done = i[keep], j[keep], equal[keep], n
    return i, j, equal


def sketches(docs: DataFrame, text: str, carry: tuple[str, ...]) -> DataFrame:
    """carry, digest of the text (null without words), n_shingles, signature."""
    schema = docs.select(*carry).schema
    for field in fields_of("digest binary, n_shingles long, signature binary"):
        schema = schema.add(field)
    n = len(carry)

    def run(batches):
        hashes = word_hashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = [shingles(t, hashes) for t in texts(batch.column(n + 1))]
                some = [k for k, s in enumerate(sets) if len(s)]
                made = [None] * len(sets)
                if some:
                    for k, row in zip(some, signatures([sets[k] for k in some]), strict=True):
                        made[k] = row.tobytes()
                digests = [d if m else None for d, m in
                           zip(batch.column(n).to_pylist(), made, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in range(n)]
                    + [pa.array(digests, pa.binary()),
                       pa.array([len(s) for s in sets], pa.int64()),
                       pa.array(made, pa.binary())], schema.names)

    return (docs.select(*carry, F.unhex(F.md5(F.col(text))).alias("__digest"),
                        F.col(text).alias("__text")).mapInArrow(run, schema))


def bucket_rows(classes: DataFrame) -> DataFrame:
    """(digest, band, bucket, n): the classes of every bucket with n >= 2 of them."""
    rows = classes.select("digest", F.posexplode(F.array(*(
        F.xxhash64(F.substring("signature", 1 + 4 * ROWS * b, 4 * ROWS), F.lit(b))
        for b in range(BANDS)))).alias("band", "bucket"))
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(counts, "bucket")


def pairs_in_bucket(table: pa.Table, bounds: dict[int, int]) -> np.ndarray | None:
    """Rows (i, j, equal) for the pairs of a bucket's chunks that are in different groups,
    survive the batches and meet first in this band; none if there can be none."""
    sig = matrix(table.column("signature"), np.uint32)
    chunk = table.column("c").to_numpy()
    group = np.unique(np.array(table.column("component").to_pylist(), object),
                      return_inverse=True)[1].reshape(-1)
    band, c1, c2 = (table.column(k)[0].as_py() for k in ("band", "c1", "c2"))
    left = np.flatnonzero(chunk == c1)
    right = left if c1 == c2 else np.flatnonzero(chunk == c2)
    if not len(left) or not len(right) or group.min() == group.max():
        return None
    found = []
    for at in range(0, len(left), 64):
        rows = left[at:at + 64]
        i, j, equal = similar_enough(sig[rows], sig[right], bounds)
        i, j = rows[i], right[j]
        ok = (group[i] != group[j]) & ((i < j) | (c1 != c2))
        i, j, equal = i[ok], j[ok], equal[ok]
        if band and len(i):  # bands before this one in which the pair meets as well
            before = (sig[i, :band * ROWS] == sig[j, :band * ROWS]).reshape(-1, band, ROWS)
            first = ~before.all(2).any(1)
            i, j, equal = i[first], j[first], equal[first]
        found.append(np.stack([i, j, equal], 1))
    return np.concatenate(found)


def by_bucket(members: DataFrame, task) -> DataFrame:
    """(a, b) of what ``task`` yields for the rows of each pair of chunks of each bucket."""
    keys = ["bucket", "c1", "c2"]
    dealt = (chunk_pairs(members, "digest", "n", CHUNK).repartition(*keys)
             .sortWithinPartitions(*keys))

    def run(batches):
        for table in sorted_runs(batches, keys):
            for at in range(0, len(found := task(table) if len(table) > 1 else []), 10_000):
                a, b = zip(*found[at:at + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return dealt.mapInArrow(run, "a binary, b binary")


def best_partners(members: DataFrame, threshold: float, partners: int) -> DataFrame:
    """Surviving pairs (a, b) of digests, of each class the most similar ones per chunk."""
    bounds = least_equal(threshold)

    def task(table):
        pairs = pairs_in_bucket(table, bounds)
        if pairs is None or not len(pairs):
            return []
        keep = np.zeros(len(pairs), bool)
        for side in (0, 1):
            order = np.lexsort((-pairs[:, 2], pairs[:, side]))
            own = pairs[order, side]
            rank = np.arange(len(own)) - np.searchsorted(own, own)
            keep[order[rank < partners]] = True
        names = table.column("digest").to_pylist()
        return [(names[i], names[j]) for i, j in pairs[keep, :2].tolist()]

    return by_bucket(members, task)


def common_of(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def linked(x: np.ndarray, y: np.ndarray, per_cent: int) -> bool:
    if 100 * min(len(x), len(y)) < per_cent * max(len(x), len(y)):
        return False
    common = common_of(x, y)
    return 100 * common >= per_cent * (len(x) + len(y) - common)


def joining_links(members: DataFrame, per_cent: int) -> DataFrame:
    """Links (a, b) between different groups, verified on the sets: of every pair of chunks
    enough of them to join all groups that have a link there."""
    bounds = least_equal(per_cent / 100)

    def task(table):
        pairs = pairs_in_bucket(table, bounds)
        if pairs is None or not len(pairs):
            return []
        names = table.column("digest").to_pylist()
        groups = table.column("component").to_pylist()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
        up = {g: g for g in groups}

        def root(g):
            while up[g] != g:
                up[g] = up[up[g]]
                g = up[g]
            return g

        found = []
        for i, j in pairs[np.argsort(-pairs[:, 2], kind="stable"), :2].tolist():
            a, b = root(groups[i]), root(groups[j])
            if a != b and linked(sets[i], sets[j], per_cent):
                up[max(a, b)] = min(a, b)
                found.append((names[i], names[j]))
        return found

    return by_bucket(members, task)


def full_sets(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(digest, shingles) of the distinct texts whose digest is ``wanted``."""
    rows = docs.select(F.unhex(F.md5(F.col(text))).alias("digest"), F.col(text).alias("body"))
    rows = rows.join(wanted, "digest", "left_semi")

    def run(batches):
        hashes = word_hashes()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shingles(t, hashes).tobytes()
                                            for t in texts(batch.column(1))], pa.binary())],
                ["digest", "shingles"])

    # one row of a text is enough; which one does not matter, they are equal
    return rows.dropDuplicates(["digest"]).mapInArrow(run, "digest binary, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The pairs with 100 * common >= per_cent * united on the full sets."""
    both = (pairs.join(sets.select(F.col("digest").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("digest").alias("b"), F.col("shingles").alias("y")), "b")
            .select("a", "b", "x", "y"))

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                keep = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), per_cent)
                        for x, y in zip(*(batch.column(c).to_pylist() for c in (2, 3)),
                                        strict=True)]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, per_cent: int = 85, key: str = "doc_id", text: str = "text",
                    carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Adds n_shingles, component_id (smallest key in reach), kept (key = component_id) and
    group_id (the same for all documents of a group; null without words)."""
    if not math.isclose(per_cent, int(per_cent)) or not 50 <= per_cent <= 100:
        raise ValueError("per_cent: 50 to 100")
    base = stored(sketches(docs, text, tuple(dict.fromkeys([*carry, key]))))
    classes = stored(base.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min(key).alias("least"), F.first("signature").alias("signature")))
    buckets = bucket_rows(classes)
    members = stored(buckets.join(classes.select("digest", "signature"), "digest"))
    sets = stored(full_sets(docs, text, members.select("digest").distinct()))

    first = best_partners(members.withColumn("component", F.col("digest")), per_cent / 100,
                          PARTNERS)
    links = checkpointed(confirmed(first.distinct(), sets, per_cent))
    groups = components(links)
    again = (members.drop("n").join(groups.withColumnRenamed("node", "digest"), "digest", "left")
             .withColumn("component", F.coalesce("component", "digest")))
    mixed = (again.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("component").alias("least"),
        F.max("component").alias("most")).where("least < most").select("bucket", "n"))
    rest = joining_links(again.join(mixed, "bucket").join(sets, "digest"), per_cent)
    done = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
    groups = components(done.unionByName(rest))

    named = classes.select("digest", "least").join(
        groups.withColumnRenamed("node", "digest"), "digest", "left")
    lowest = (named.where(F.col("component").isNotNull()).groupBy("component")
              .agg(F.min("least").alias("lowest")))
    named = checkpointed(named.join(lowest, "component", "left")
                         .select("digest", F.coalesce("lowest", "least").alias("component_id"),
                                 F.coalesce("component", "digest").alias("group_id")))
    return (base.drop("signature").join(named, "digest", "left")
            .withColumn("component_id", F.coalesce("component_id", key))
            .select(*carry, "n_shingles", "component_id",
                    F.col(key).eqNullSafe(F.col("component_id")).alias("kept"), "group_id"))


def one_of_each_group(docs: DataFrame, per_cent: int = 85, key: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """The documents without their near duplicates: of each group one with the smallest key
    stays. Documents without words have no group and stay."""
    rows = hidden(docs)
    body, name = F.col(f"in_{text}"), F.coalesce(F.col(f"in_{key}").cast("string"), F.lit(""))
    rows = rows.withColumns({"own_digest": F.unhex(F.md5(body)), "own_name": name})
    # the texts stay where they are: only digests and ids go through the search
    marked = near_duplicates(rows, per_cent, f"in_{key}", f"in_{text}", ("own_digest", "own_name"))
    # the smallest key may occur twice in a group, with different texts, or be null
    wanted = (marked.where(F.col("kept") & F.col("group_id").isNotNull()).groupBy("group_id")
              .agg(F.min(F.struct("own_name", "own_digest")).alias("one"))
              .select("one.own_digest", "one.own_name"))
    # repeated rows share both columns, and rows are joined by both: no further shuffle
    grouped = rows.join(wanted, ["own_digest", "own_name"], "left_semi").dropDuplicates(
        ["own_digest", "own_name"])
    wordless = rows.where(~F.coalesce(body.rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return shown(grouped.unionByName(wordless), docs)

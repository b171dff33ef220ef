"""Keyed tables on plain parquet: the sinks and stores of the streaming jobs.

Every micro-batch writes its rows to a folder of its own, named by the batch number. A
batch that is run again replaces its folder, so nothing is counted twice. Readers see the
last row of each key; a reader inside batch n looks only at batches before n and so gives
the same answer when it is repeated.

Folding writes the last rows of the batches so far into a base that is partitioned by a hash
of the key, into so many parts that one stays small however large the table is. A batch that
names its keys reads the parts of the base that can hold them, and the few batches after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.running import upsert_latest

BATCH, PART, WRITTEN = "_batch", "_part", "_written"
PART_BYTES = 16 << 20  # of one part of a base, about
MOST_PARTS = 1 << 14


def part_of(keys, parts: int) -> Column:
    """Part of a base that holds a key."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(parts)).cast("int")


def older_than(age: str, at: Column) -> Column:
    """Whether a row was written more than ``age`` before ``at``."""
    return F.col(WRITTEN) < F.unix_micros(at - F.expr(f"interval {age}"))


def _valid(rows: DataFrame, expired: Column | None) -> DataFrame:
    return rows if expired is None else rows.filter(~F.coalesce(expired, F.lit(False)))


class KeyedTable:
    """Rows identified by ``keys``; of the rows of a key, the last one counts.

    ``order`` says which row of one batch is last, where a batch may hold several of a
    key; leave it empty where it cannot. ``by`` are the keys that decide the part of a base,
    all by default.
    """

    def __init__(self, path: str, keys, order=(), by=()):
        self.path, self.keys, self.order = path.rstrip("/"), list(keys), list(order)
        self.by = list(by or keys)

    def write_batch(self, df: DataFrame, batch: int, at: Column | None = None) -> None:
        """Store the rows of a batch, in place of any earlier try of the same batch. ``at`` is
        the time of the batch, kept where rows are to expire."""
        rows = df if at is None else df.withColumn(WRITTEN, F.unix_micros(at))
        rows.write.mode("overwrite").parquet(self._folder("delta", batch))

    def changelog(self, spark: SparkSession, before: int | None = None,
                  among: DataFrame | None = None) -> DataFrame | None:
        """Rows of the newest base and of the batches after it; None if there are none.
        ``among``, rows with the columns ``by``, leaves out parts that hold none of its keys."""
        bases = self._folders(spark, "base", before)
        start = max(bases, default=-1)
        found = [self._read_base(spark, start, bases[start], among)] if bases else []
        found += [spark.read.parquet(self._folder("delta", b)).withColumn(BATCH, F.lit(b))
                  for b in self._complete(spark, "delta", before) if b > start]
        if not found:
            return None
        out = found[0]
        for rows in found[1:]:
            out = out.unionByName(rows, allowMissingColumns=True)
        return out

    def latest(self, spark: SparkSession, before: int | None = None,
               among: DataFrame | None = None, expired: Column | None = None) -> DataFrame | None:
        """The last row of each key, without those for which ``expired`` holds. With ``among``
        some other keys may be left out."""
        rows = self.changelog(spark, before, among)
        if rows is None:
            return None
        last = upsert_latest(rows, self.keys, [BATCH, *self.order]).drop(BATCH)
        return _valid(last, expired).drop(WRITTEN)

    def compact(self, spark: SparkSession, before: int | None = None, remove: bool = False,
                expired: Column | None = None) -> None:
        """Fold all batches (those ``before`` one) into one base, without the rows for which
        ``expired`` holds.

        Older folders stay for reads as of an earlier batch, unless ``remove`` is set. Reads
        inside batch n stop before n, so removing what is folded before n changes none of
        them, however often n is repeated."""
        batches = self._complete(spark, "delta", before)
        if not batches:
            return
        end = max(batches)
        rows = upsert_latest(self.changelog(spark, before), self.keys, [BATCH, *self.order])
        rows = _valid(rows, expired).drop(BATCH)
        parts = self._parts(spark, before)
        writer = (rows.withColumn(PART, part_of(self.by, parts)).repartition(PART)
                  .write.partitionBy(PART))
        if rows.isEmpty():  # no part would tell the columns
            writer = rows.write
        writer.mode("overwrite").parquet(self._folder("base", end, parts))
        for kind, last in (("delta", end), ("base", end - 1)) if remove else ():
            for name in self._folders(spark, kind, last + 1).values():
                self._remove(spark, f"{self.path}/{kind}/{name}")

    def of_batch(self, spark: SparkSession, batch: int) -> DataFrame | None:
        """The rows a batch wrote; None if it has not finished."""
        folder = self._folder("delta", batch)
        if not self._fs(spark, folder).exists(self._place(spark, f"{folder}/_SUCCESS")):
            return None
        return spark.read.parquet(folder)

    def _read_base(self, spark, batch: int, name: str, among: DataFrame | None) -> DataFrame:
        rows = spark.read.parquet(f"{self.path}/base/{name}")
        if among is not None and PART in rows.columns:
            parts = int(name.partition("-")[2])
            # at most as many numbers as there are parts
            wanted = among.select(part_of(self.by, parts).alias(PART)).distinct().collect()
            rows = rows.filter(F.col(PART).isin([r[PART] for r in wanted]))
        # a base ranks by the last batch in it, below every later batch
        return rows.drop(PART).withColumn(BATCH, F.lit(batch))

    def _parts(self, spark, before) -> int:
        """Parts of the next base, from the bytes that are folded into it."""
        bases = self._folders(spark, "base", before)
        folders = [f"base/{bases[max(bases)]}"] if bases else []
        folders += [f"delta/{name}" for name in self._folders(spark, "delta", before).values()]
        size = sum(self._fs(spark, self.path).getContentSummary(
            self._place(spark, f"{self.path}/{f}")).getLength() for f in folders)
        return min(MOST_PARTS, 1 << (size // PART_BYTES).bit_length())

    def _folder(self, kind: str, batch: int, parts: int | None = None) -> str:
        return f"{self.path}/{kind}/{batch}" + (f"-{parts}" if parts else "")

    def _place(self, spark, path: str):
        return spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, spark, path: str):
        return self._place(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _remove(self, spark, path: str) -> None:
        self._fs(spark, path).delete(self._place(spark, path), True)

    def _complete(self, spark, kind: str, before: int | None) -> list[int]:
        return list(self._folders(spark, kind, before))

    def _folders(self, spark, kind: str, before: int | None) -> dict[int, str]:
        """Folders whose write finished: batch number -> name."""
        fs, root = self._fs(spark, self.path), f"{self.path}/{kind}"
        if not fs.exists(self._place(spark, root)):
            return {}
        found = {}
        for status in fs.listStatus(self._place(spark, root)):
            name = status.getPath().getName()
            number = name.partition("-")[0]
            if (number.isdigit() and (before is None or int(number) < before)
                    and fs.exists(self._place(spark, f"{root}/{name}/_SUCCESS"))):
                found[int(number)] = name
        return dict(sorted(found.items()))

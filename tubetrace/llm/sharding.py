"""Shards of even row counts by balanced label propagation (operator 9).

Documents with equal texts are linked. Every document starts in a shard dealt by a hash. In
each round the members that a group has in a shard see where most of their neighbours are
and ask to move there; a shard takes what fits its quota of rows, so linked documents meet
and few links are cut while sizes stay even. A group larger than a quota spreads over as few
shards as the quotas allow. At last the shards over their size hand rows to those below, the
unlinked first, so that row counts are at most one apart (law ``rows``).

Work is on counts by (group, first shard, shard), never on the members of a group together;
moves are taken by a histogram of requests of at most ``shards * BUCKETS`` rows, and ranks
are made of a rank in a bucket and the sizes of the buckets before. Only DataFrame functions
are used.

Null texts are linked with nothing and count one byte. Equal rows, rows without an id and
ids that occur twice are documents of their own. An empty table gives an empty one. Of
further columns only ``carry`` is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, stored

BUCKETS = 1024
SLACK = 0.5


def propagate(groups: DataFrame, shards: int, quota: DataFrame, rounds: int = 8) -> DataFrame:
    """``groups``: (key, origin, shard, n), n linked documents that began in ``origin`` and
    are in ``shard`` now; ``quota``: (shard, quota), one row per shard. Gives the rows with
    the shards they moved to, after ``rounds`` rounds or when no move fits."""
    state = checkpointed(groups)
    for turn in range(rounds):
        load = state.groupBy("shard").agg(F.sum("n").alias("load"))
        # loads may pass the quotas at first, or full shards could not exchange anything
        allowed = F.ceil(F.col("quota") * F.lit(1 + SLACK * (rounds - 1 - turn) / rounds))
        room = (quota.join(load, "shard", "left")
                .withColumn("room", allowed - F.coalesce("load", F.lit(0))))
        # ties go by a hash of key and shard, or all would want the first shards
        here = (state.groupBy("key", "shard").agg(F.sum("n").alias("here"))
                .withColumn("pull", F.struct("here", F.xxhash64("key", "shard").alias("h"), "shard")))
        # shards and rooms: one row a shard
        best = (here.join(F.broadcast(room.where("room > 0").select("shard")), "shard")
                .groupBy("key").agg(F.max("pull").alias("best")))
        asking = (state.join(here.select("key", "shard", "pull"), ["key", "shard"])
                  .join(best, "key").where(F.col("best") > F.col("pull"))
                  .select("key", "origin", "shard", "n", F.col("best.shard").alias("target"),
                          F.pmod(F.xxhash64("key", "origin", F.lit(turn)), F.lit(BUCKETS))
                          .alias("bucket")))
        # a bucket of requests is taken whole or not at all, small ones first
        requests = asking.groupBy("target", "bucket").agg(F.sum("n").alias("wanted"))
        by_size = Window.partitionBy("target").orderBy("wanted", "bucket")
        rooms = room.select(F.col("shard").alias("target"), "room")
        # at most shards * BUCKETS rows
        taken = (requests.withColumn("total", F.sum("wanted").over(by_size))
                 .join(F.broadcast(rooms), "target").where("total <= room")
                 .select("target", "bucket"))
        moves = (asking.join(F.broadcast(taken), ["target", "bucket"])
                 .select("key", "origin", "shard", "target"))
        moved = checkpointed(
            state.join(moves, ["key", "origin", "shard"], "left")
            .select("key", "origin", F.coalesce("target", "shard").alias("shard"), "n",
                    F.col("target").isNotNull().alias("moved")))
        state = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    return state


def ranked(rows: DataFrame, within: list[str], first: str, identity: str) -> DataFrame:
    """Adds ``rank``, from 0 and without gaps in each ``within``: rows with a true ``first``
    come first, then by buckets of a hash of ``identity``."""
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(identity), F.lit(BUCKETS)))
    group = [*within, first, "bucket"]
    sizes = rows.groupBy(*group).agg(F.count("*").alias("size"))
    order = Window.partitionBy(*within).orderBy(F.desc(first), "bucket")
    before = sizes.withColumn("before", F.sum("size").over(order) - F.col("size")).drop("size")
    inside = Window.partitionBy(*group).orderBy(identity)
    # at most 2 * BUCKETS rows for each ``within``
    return (rows.withColumn("inside", F.row_number().over(inside) - 1)
            .join(F.broadcast(before), group)
            .withColumn("rank", F.col("inside") + F.col("before"))
            .drop("inside", "before", "bucket"))


def shard_rows(docs: DataFrame, shards: int = 16, rounds: int = 8, text: str = "text",
               carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Adds size, text_crc32, shard and slot to the carried columns."""
    spark = docs.sparkSession
    utf8 = F.coalesce(F.col(text), F.lit("")).cast("binary")
    base = stored(docs.select(
        *carry, (F.length(utf8) + 1).cast("long").alias("size"),
        F.crc32(utf8).alias("text_crc32"), F.unhex(F.md5(F.col(text))).alias("key"),
        F.monotonically_increasing_id().alias("uid"))).withColumn(
            "origin", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int"))
    total = base.count()
    target = spark.range(shards, numPartitions=1).select(
        F.col("id").cast("int").alias("shard"),
        (F.lit(total // shards) + (F.col("id") < total % shards).cast("long")).alias("quota"))

    linked = (base.where(F.col("key").isNotNull()).groupBy("key", "origin")
              .agg(F.count("*").alias("n")))
    linked = (linked.join(linked.groupBy("key").agg(F.sum("n").alias("all")).where("all > 1")
                          .select("key"), "key")
              .select("key", "origin", F.col("origin").alias("shard"), "n"))
    homes = propagate(linked, shards, target, rounds).select(
        "key", "origin", F.col("shard").alias("home"))
    placed = base.join(homes, ["key", "origin"], "left").select(
        *carry, "size", "text_crc32", "uid", F.coalesce("home", "origin").alias("shard"),
        F.col("home").isNotNull().alias("linked"))
    placed = ranked(stored(placed), ["shard"], "linked", "uid").join(F.broadcast(target), "shard")

    stays = F.col("rank") < F.col("quota")
    placed = stored(placed.withColumn("over", ~stays))
    # the shards with room and the numbers of the rows that they take: one row a shard
    loads = placed.groupBy("shard").agg(F.count("*").alias("load"))
    room = (target.join(loads, "shard", "left")
            .withColumn("load", F.coalesce("load", F.lit(0)))
            .withColumn("room", F.greatest(F.col("quota") - F.col("load"), F.lit(0))))
    line = Window.partitionBy(F.lit(0)).orderBy("shard")
    room = (room.withColumn("upto", F.sum("room").over(line)).where("room > 0")
            .select(F.col("shard").alias("new_shard"), "load", (F.col("upto") - F.col("room"))
                    .alias("since"), "upto"))
    names = [*carry, "size", "text_crc32"]
    stay = placed.where(~F.col("over")).select(*names, "shard", F.col("rank").alias("slot"))
    move = (ranked(placed.where("over").drop("rank").withColumn("all", F.lit(0)),
                   ["all"], "linked", "uid")
            .join(F.broadcast(room), (F.col("rank") >= F.col("since"))
                  & (F.col("rank") < F.col("upto")))
            .select(*names, F.col("new_shard").alias("shard"),
                    (F.col("load") + F.col("rank") - F.col("since")).alias("slot")))
    return stay.unionByName(move).withColumn("slot", F.col("slot").cast("long"))

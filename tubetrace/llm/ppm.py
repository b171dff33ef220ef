"""Text scores by prediction by partial matching (operator 3).

A text is read as its tokens: words with A-Z lower-cased, one space between two of them, and
one end, the byte 255, which no UTF-8 text holds. The model is a trie of byte contexts of up
to ``ORDER`` bytes. In a context that has been seen t times with d different bytes after it, a
byte seen there n times has probability (2n - 1) / 2t, and d / 2t is left for the escape to
the context without its first byte. There the bytes of the longer context are excluded: they
would have been coded there. Below the empty context every byte not seen at all is equally
likely. A text begins in a context of ``ORDER`` zero bytes; its score is the log10 probability
of its bytes and the end, so it rates the same tokens as the base score does.

Corpus counts cover every training text and are made by Spark: bytes in contexts and words,
counted per task and added by key. What goes to all tasks is bounded by parameters: the
contexts of the trie that hold ``SHARE`` of all bytes or more, ``CAPACITY`` entries at most (the
contexts of no and one byte are always there), and the counts of the ``FREQUENT`` most frequent
words. As a share of the bytes and not a number of contexts is the measure, the part of a text that
the trie leaves open, and with it the rows of the joins per text, is the same for a small and
a large corpus. Everything else stays in Spark and is looked up by joins: the words that are not among the
frequent ones, and the contexts that are not in the trie. The probability of a byte depends
on the ``ORDER`` bytes before it only, so each distinct context and byte that the trie cannot
answer is looked up once; the counts that find it give what the whole trie would give.

The base score is an add-one model of words: A-Z lower-cased, one end per text counted as a
token of its own.

Null texts are empty: one token, the end. Texts of any length are scored whole. Rows with a
null id count as id ''. Repeated rows and ids are texts of their own, in the counts as well.
Without training texts all words are unknown and each byte costs as much as any other. An
empty table gives an empty one. Of further columns only ``carry`` is kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TO_LOWER, fields_of, portions, stored, texts  # noqa: F401

ORDER = 5
CAPACITY = 1 << 20
SHARE = 2.0 ** -21
FREQUENT = 1 << 18
END_WORD = b""  # no word is empty
END_BYTE = b"\xff"
SYMBOLS = 256
KEYS_AT_ONCE = 1 << 20  # bytes of which contexts are made at once; a longer text goes alone
FLUSH = 400_000  # distinct words or contexts a task holds before it puts them out


def gram_keys(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every text and its end: the byte with the ``ORDER`` before it, as a
    number that begins with a 1 byte. Also where each text starts."""
    pad = bytes(ORDER)
    buffer = np.frombuffer(b"".join(pad + t + END_BYTE for t in bodies), np.uint8)
    sizes = np.array([len(t) + 1 for t in bodies], np.int64)
    ends = np.cumsum(sizes + ORDER)
    inside = np.ones(len(buffer), bool)
    for k in range(1, ORDER + 1):
        inside[ends - k] = False
    inside = inside[:len(buffer) - ORDER]
    pairs = buffer[:-1].astype(np.int64) << 8
    pairs |= buffer[1:]
    keys = np.full(len(buffer) - ORDER, 1, np.int64)
    for k in range(0, ORDER + 1, 2):  # an even number of bytes
        keys <<= 16
        keys |= pairs[k:len(buffer) - ORDER + k]
    return keys[inside], np.cumsum(sizes) - sizes


def shorter(keys: np.ndarray, size: int) -> np.ndarray:
    """The last ``size`` bytes of keys."""
    unit = np.int64(1) << np.int64(8 * size)
    return keys & (unit - 1) | unit


def tokens(column: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """Of texts: their words with one space between two of them, the distinct tokens of all,
    the place of each token there, text after text, and where the tokens of each text end."""
    lowered = pc.ascii_lower(column.cast(pa.string()).fill_null(""))
    cut = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(lowered))
    bodies, runs, ends = pc.binary_join(cut, " "), cut.values.dictionary_encode(), cut.offsets.to_numpy()
    distinct, codes = runs.dictionary.cast(pa.binary()), runs.indices.to_numpy()
    # a text without words is cut into one empty word, which serves as its end
    some = pc.binary_length(bodies).to_numpy() > 0
    end = pc.index(distinct, pa.scalar(END_WORD, pa.binary())).as_py()
    if end < 0:
        end = len(distinct)
        distinct = pa.concat_arrays([distinct, pa.array([END_WORD], pa.binary())])
    return bodies, distinct, np.insert(codes, ends[1:][some], end), ends[1:] + np.cumsum(some)


def counted(owners: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ``owners`` and ``values``, by owner, and how often each is there."""
    order = np.lexsort((values, owners))
    o, v = owners[order], values[order]
    change = (o[1:] != o[:-1]) | (v[1:] != v[:-1])
    first = np.flatnonzero(np.append(np.full(min(len(o), 1), True), change))
    return o[first], v[first], np.diff(np.append(first, len(o)))


def lists(owners: np.ndarray, rows: int, items: dict[str, pa.Array]) -> pa.Array:
    """One list of structs per row out of items that are sorted by the row that owns them."""
    cuts = np.searchsorted(owners, np.arange(rows + 1))
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()),
                                    pa.StructArray.from_arrays(list(items.values()), list(items)))


def corpus_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, gram, n): how often each word and each byte in its context occurs."""

    names = ["word", "gram", "n"]

    def run(batches):
        words, keys, counts = [], [], []

        def merged_words():
            return (pa.Table.from_batches(words).group_by("word", use_threads=False)
                    .aggregate([("n", "sum")]).rename_columns(["word", "n"]).combine_chunks().to_batches())

        def merged():
            k, n = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(k, kind="stable")
            k, n = k[order], n[order]
            first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            return k[first], np.add.reduceat(n, first)

        def word_rows():
            for found in words:
                yield pa.RecordBatch.from_arrays(
                    [found.column("word"), pa.nulls(len(found), pa.int64()), found.column("n")], names)

        def gram_rows(k, n):
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(k), pa.binary()), pa.array(k), pa.array(n)], names)

        for whole in batches:
            for at, size in portions(whole.column(0)):
                bodies, distinct, codes, _ = tokens(whole.column(0).slice(at, size))
                n = np.bincount(codes, minlength=len(distinct))
                words.append(pa.RecordBatch.from_arrays([distinct, pa.array(n)], ["word", "n"]))
                for first, some in portions(bodies, KEYS_AT_ONCE):
                    k, n = np.unique(gram_keys(texts(bodies.slice(first, some)))[0], return_counts=True)
                    keys.append(k)
                    counts.append(n)
                if sum(map(len, words)) > 4 * FLUSH:
                    words = merged_words()
                    if sum(map(len, words)) > FLUSH:
                        yield from word_rows()
                        words = []
                if sum(map(len, keys)) > 4 * FLUSH:
                    k, n = merged()
                    keys, counts = [k], [n]
                    if len(k) > FLUSH:
                        yield gram_rows(k, n)
                        keys, counts = [], []
        if words:
            words = merged_words()
            yield from word_rows()
        if keys:
            yield gram_rows(*merged())

    rows = docs.select(F.col(text).alias("__text")).mapInArrow(
        run, "word binary, gram long, n long")
    return rows.groupBy("word", "gram").agg(F.sum("n").alias("n"))


def split(rows: DataFrame, size: str, weight: str,
          capacity: int, least_size: float = 0) -> tuple[DataFrame, DataFrame | None]:
    """The rows with the highest ``size``, ``least_size`` or more, of which the ``weight`` adds
    up to ``capacity`` at most, and the others, None if there are none; sizes are compared by the
    eighth of a power of two, so no sort is needed."""
    level = F.floor(F.log2(size) * 8)
    levels = rows.groupBy(level.alias("level")).agg(F.sum(weight).alias("w")).collect()  # <= 512
    least, total = math.inf, 0
    for row in sorted(levels, key=lambda r: -r["level"]):
        total += row["w"]
        if total > capacity or 2 ** ((row["level"] + 1) / 8) <= least_size:
            break
        least = row["level"]
    else:
        return rows, None
    if not math.isfinite(least):
        return rows.limit(0), rows
    return rows.where(level >= F.lit(least)), rows.where(level < F.lit(least))


class Lookup:
    """Positions of known keys, by open addressing."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        bits = max(4, (2 * len(keys)).bit_length())  # at most half full
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.int64)
        self.place = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.keys[slot] == 0
            won, first = np.unique(slot[free], return_index=True)
            winners = np.flatnonzero(free)[first]
            self.keys[won], self.place[won] = keys[left[winners]], left[winners]
            rest = np.ones(len(left), bool)
            rest[winners] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys):
        return (keys.astype(np.uint64) * self.FACTOR >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, or -1."""
        slot = self._slot(keys)
        there, out = self.keys[slot], self.place[slot]
        look = np.flatnonzero(there != keys)
        out[look] = -1
        look = look[there[look] != 0]
        slot = slot[look]
        while len(look):
            slot = (slot + 1) & self.mask
            there = self.keys[slot]
            hit = there == keys[look]
            out[look[hit]] = self.place[slot[hit]]
            go = ~hit & (there != 0)
            look, slot = look[go], slot[go]
        return out


def log10(x):
    with np.errstate(divide="ignore"):
        return np.log10(x)


class Trie:
    """Probabilities of bytes in contexts. keys: contexts with the byte after them, n: counts.
    With a context all its suffixes have to be there, with all their bytes. Unless it is
    ``whole``, there are contexts of two bytes and more elsewhere."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, whole: bool = True):
        self.whole = whole
        order = np.argsort(keys)
        keys, n = keys[order], n[order].astype(np.float64)
        contexts, at, d = np.unique(keys >> 8, return_inverse=True, return_counts=True)
        t = np.bincount(at, n, len(contexts))
        self.log_n, self.top = log10(2 * n - 1), log10((2 * n - 1) / (2 * t)[at])
        self.escape = log10(d / (2 * t))
        # what is left in the next shorter context without the bytes of this one
        size = np.zeros(len(contexts), np.int64)
        for k in range(1, ORDER + 1):
            size[contexts >> (8 * k) > 0] = k
        parent = np.zeros(len(contexts), np.int64)
        for k in range(1, ORDER + 1):
            parent[size == k] = shorter(contexts[size == k], k - 1)
        inner = size[at] > 0
        below = np.searchsorted(keys, parent[at[inner]] << 8 | keys[inner] & 255)
        n_below = np.bincount(at[inner], n[below], len(contexts))
        up = np.searchsorted(contexts, parent)
        up = np.where(size > 0, up, 0)
        rest_t, rest_d = t[up] - n_below, d[up] - d
        self.left = log10(np.where(rest_d > 0, 2 * rest_t, 1))
        self.pass_on = np.where(rest_d > 0, log10(np.where(rest_d > 0, rest_d, 1)) - self.left, 0.0)
        root = contexts == 1
        self.unseen = -math.log10(max(1, SYMBOLS - int(d[root].sum())))
        self.grams, self.contexts = Lookup(keys), Lookup(contexts)
        for name in ("log_n", "top", "escape", "left", "pass_on"):
            setattr(self, name, getattr(self, name).astype(np.float32))
        self.top = np.append(self.top, np.float32(0))  # of what is not found, too

    def log_probabilities(self, keys: np.ndarray, size: int = ORDER,
                          above: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """log10 probability of the last byte of each key of ``gram_keys``, from the context of
        ``size`` bytes on; nan where the longest context may be elsewhere. above: what is left
        and what passing on costs in that context after one that is a byte longer, nan where
        there was none."""
        out = np.zeros(len(keys), np.float32)
        todo, child = np.arange(len(keys)), np.full(len(keys), -1, np.int32)
        now = keys if size == ORDER else shorter(keys, size + 1)
        for k in range(size, -1, -1) if len(self.escape) else ():
            if k < size:
                now = shorter(now, k + 1)
            found = self.grams(now)
            hit = found >= 0
            if k == size:
                out = self.top[found]
            else:
                g, c = found[hit], child[hit]
                out[todo[hit]] += np.where(c >= 0, self.log_n[g] - self.left[c], self.top[g])
            if above is not None and k == size:
                g = found[hit]
                out[hit] = np.where(np.isnan(above[0][hit]), out[hit], self.log_n[g] - above[0][hit])
            todo, child, now = todo[~hit], child[~hit], now[~hit]
            if not len(todo):
                return out
            context = self.contexts(now >> 8)
            if k == ORDER and not self.whole:
                there = context >= 0
                out[todo[~there]] = np.nan
                todo, child, now, context = todo[there], child[there], now[there], context[there]
            cost = np.where(child >= 0, self.pass_on[child],
                            np.where(context >= 0, self.escape[context], 0))
            if above is not None and k == size:
                cost = np.where(np.isnan(above[1][todo]), cost, above[1][todo])
            out[todo] += cost
            child = np.where(context >= 0, context, child)
        out[todo] += np.float32(self.unseen)
        return out

    def longest(self, keys: np.ndarray) -> np.ndarray:
        """How many bytes the longest context of each key has that is there."""
        out = np.zeros(len(keys), np.int64)
        for k in range(1, ORDER + 1):
            out[self.contexts(shorter(keys >> 8, k)) >= 0] = k
        return out


def build_trie(counts: DataFrame, capacity: int,
               share: float = SHARE) -> tuple[Trie, DataFrame, DataFrame | None]:
    """The trie of the contexts with ``share`` of the bytes or more, (key, n) of all, and
    (context, t, d, rest_t, rest_d) of the contexts that are not in it, None if there are none;
    ``capacity`` bounds what comes to the driver."""
    sizes = range(1, ORDER + 2)
    suffix = F.explode(F.array(*(
        F.col("gram").bitwiseAND(F.lit((1 << 8 * s) - 1)) + F.lit(1 << 8 * s) for s in sizes)))
    grams = (counts.where(F.col("gram").isNotNull()).select(suffix.alias("key"), "n")
             .groupBy("key").agg(F.sum("n").alias("n"))
             .withColumn("context", F.shiftright("key", 8)))
    grams = stored(grams)
    contexts = grams.groupBy("context").agg(F.sum("n").alias("t"), F.count("*").alias("d"))
    short = F.col("context") < (1 << 16)  # no byte or one
    n_bytes = grams.where(F.col("context") == 1).agg(F.sum("n")).first()[0] or 0
    kept, rest = split(contexts.where(~short), "t", "d", capacity, share * n_bytes)
    kept = contexts.where(short).select("context").union(kept.select("context"))
    rows = grams.join(kept, "context").select("key", "n").toArrow()
    trie = Trie(rows.column("key").to_numpy(), rows.column("n").to_numpy(), rest is None)
    return trie, grams.select("key", "n"), None if rest is None else stored(
        rare_contexts(grams, contexts, rest))


def without_first(column: str) -> Column:
    """A key or context without its first byte."""
    c, out = F.col(column), F.lit(None)
    for s in range(ORDER + 1, 0, -1):
        unit = 1 << 8 * (s - 1)
        out = F.when(c < 1 << 8 * s + 1, c.bitwiseAND(F.lit(unit - 1)) + F.lit(unit)).otherwise(out)
    return out


def rare_contexts(grams: DataFrame, contexts: DataFrame, rare: DataFrame) -> DataFrame:
    """The ``rare`` ones of the contexts with what is left in the next shorter context without
    their bytes. No more than 256 rows meet a row in either join."""
    below = (grams.join(rare.select("context"), "context")
             .select("context", without_first("key").alias("key"))
             .join(grams.select("key", "n"), "key")
             .groupBy("context").agg(F.sum("n").alias("below")))
    up = contexts.select(F.col("context").alias("up"), F.col("t").alias("t_up"),
                         F.col("d").alias("d_up"))
    return (rare.join(below, "context").withColumn("up", without_first("context"))
            .join(up, "up").select("context", "t", "d", (F.col("t_up") - F.col("below")).alias("rest_t"),
                                   (F.col("d_up") - F.col("d")).alias("rest_d")))


def looked_up(keys: DataFrame, shared, grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """(key, log) for distinct keys that the trie ``shared`` has no answer for."""
    sizes = range(ORDER, 1, -1)

    def probe(batches):
        model = shared.value[0]
        for batch in batches:
            key = batch.column(0).to_numpy()
            longest = model.longest(key)
            rows = [(key[at], np.full(len(at), s), shorter(key[at], s + 1))
                    for s in sizes for at in [np.flatnonzero(longest < s)]]
            key, size, gram = map(np.concatenate, zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(size, pa.int64()), pa.array(gram), pa.array(gram >> 8)],
                ["key", "size", "gram", "context"])

    names = ("n", "t", "d", "rest_t", "rest_d")
    found = (keys.mapInArrow(probe, "key long, size long, gram long, context long")
             .join(contexts, "context", "left")
             .join(grams.select(F.col("key").alias("gram"), "n"), "gram", "left")
             .groupBy("key").agg(*(
                 F.coalesce(F.max(F.when(F.col("size") == s, F.col(c))), F.lit(0)).alias(f"{c}{s}")
                 for s in sizes for c in names)))

    def solve(batches):
        model = shared.value[0]
        for batch in batches:
            key = batch.column(0).to_numpy()
            out, done = np.zeros(len(key)), np.zeros(len(key), bool)
            left, passed = np.full(len(key), np.nan), np.full(len(key), np.nan)
            for s in sizes:
                n, t, d, rest_t, rest_d = (
                    batch.column(f"{c}{s}").to_numpy().astype(np.float64) for c in names)
                at = np.flatnonzero((t > 0) & ~done)
                n, t, d, rest_t, rest_d = n[at], t[at], d[at], rest_t[at], rest_d[at]
                first, hit = np.isnan(left[at]), n > 0
                gone = np.log10(np.maximum(2 * n - 1, 1)) - np.where(first, np.log10(2 * t), left[at])
                escaped = np.where(first, np.log10(d / (2 * t)), passed[at])
                out[at] += np.where(hit, gone, escaped)
                done[at] = hit
                some = rest_d > 0
                left[at] = np.log10(np.where(some, 2 * rest_t, 1))
                passed[at] = np.log10(np.where(some, rest_d, 1)) - left[at]
            longest = model.longest(key)
            for s in range(ORDER):
                at = np.flatnonzero((longest == s) & ~done)
                out[at] += model.log_probabilities(key[at], s, (left[at], passed[at]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["key", "log"])

    return found.mapInArrow(solve, "key long, log double")


def score_documents(docs: DataFrame, training: Column, text: str = "text",
                    carry: tuple[str, ...] = ("doc_id",), capacity: int = CAPACITY,
                    frequent: int = FREQUENT) -> DataFrame:
    """Adds n_tokens, n_known, train_tokens, base_score and score to the carried columns; the
    rows for which ``training`` holds are what is learned from."""
    spark = docs.sparkSession
    counts = stored(corpus_counts(docs.where(training), text))
    trie, grams, contexts = build_trie(counts, capacity)
    vocabulary = counts.where(F.col("word").isNotNull()).select("word", F.col("n").alias("c"))
    totals = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_train, n_types = totals
    common = split(vocabulary.withColumn("one", F.lit(1)), "c", "one", frequent)[0].toArrow()
    # both are bounded by parameters
    shared = spark.sparkContext.broadcast((
        trie, common.column("word").combine_chunks(), common.column("c").to_numpy()))
    schema = docs.select(*carry).schema
    for field in fields_of("n_tokens long, known long, logs double, score double, "
                           "rare array<struct<word binary, times long>>, "
                           "open array<struct<key long, times long>>"):
        schema = schema.add(field)

    def run(batches):
        model, kept, numbers = shared.value
        logs = np.append(np.log10(numbers + 1.0), 0)
        for whole in batches:
            for at, size in portions(whole.column(len(carry))):
                batch = whole.slice(at, size)
                bodies, distinct, codes, ends = tokens(batch.column(len(carry)))
                starts = np.append(0, ends[:-1])
                place = pc.index_in(distinct, kept).fill_null(-1).to_numpy()
                sums = np.add.reduceat(logs[place][codes], starts)
                unknown = np.flatnonzero((place < 0)[codes])
                owner, word, times = counted(np.searchsorted(ends, unknown, "right"), codes[unknown])
                rare = lists(owner, size, {"word": distinct.take(pa.array(word)), "times": pa.array(times)})
                known = np.diff(ends, prepend=0) - np.bincount(owner, times, size).astype(np.int64)
                score, owners, open_keys = [], [], []
                for first, some in portions(bodies, KEYS_AT_ONCE):
                    keys, key_starts = gram_keys(texts(bodies.slice(first, some)))
                    logs_of = model.log_probabilities(keys)
                    at_open = np.flatnonzero(np.isnan(logs_of))
                    logs_of[at_open] = 0
                    score.append(np.add.reduceat(logs_of, key_starts, dtype=np.float64))
                    owners.append(first + np.searchsorted(key_starts, at_open, "right") - 1)
                    open_keys.append(keys[at_open])
                owner, key, times = counted(np.concatenate(owners), np.concatenate(open_keys))
                left_open = lists(owner, size, {"key": pa.array(key), "times": pa.array(times)})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in range(len(carry))]
                    + [pa.array(np.diff(ends, prepend=0), pa.int64()), pa.array(known), pa.array(sums),
                       pa.array(np.concatenate(score)), rare, left_open],
                    schema.names)

    scored = stored(docs.select(*carry, F.col(text).alias("__text")).mapInArrow(run, schema)
                    .withColumn("__row", F.monotonically_increasing_id()))
    rare = (scored.select("__row", F.inline("rare"))
            .join(vocabulary, "word")
            .groupBy("__row").agg(F.sum("times").alias("more"),
                                  F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more_logs")))
    score = F.col("score")
    if contexts is not None:
        opened = scored.select("__row", F.inline("open"))
        answers = looked_up(opened.select("key").distinct(), shared, grams, contexts)
        opened = (opened.join(answers, "key").groupBy("__row")
                  .agg(F.sum(F.col("times") * F.col("log")).alias("more_score")))
        scored = scored.join(opened, "__row", "left")
        score = (score + F.coalesce("more_score", F.lit(0.0))).alias("score")
    zero = F.lit(0)
    return (scored.drop("rare", "open").join(rare, "__row", "left")
            .select(*carry, "n_tokens", (F.col("known") + F.coalesce("more", zero)).alias("n_known"),
                    F.lit(n_train).cast("long").alias("train_tokens"),
                    (F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
                     - F.col("n_tokens") * F.lit(math.log10(n_train + n_types + 1)))
                    .alias("base_score"), score))

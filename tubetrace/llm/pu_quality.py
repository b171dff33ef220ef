"""Text quality by positive-unlabelled learning (operator 10).

Trusted positives are the texts labelled 1; the other side is web text as it comes, without
labels. A small network is fitted by the non-negative unbiased risk

    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)])

where a negative estimate of the second part is turned back instead of followed. The share of
positives in the unlabelled text (the class prior) is estimated from the scores of a first
fit: above any bound b the unlabelled texts hold at least prior * P(score > b | positive), so
the smallest ratio of the two tail shares bounds the prior, up to sampling error.

Features are counts over the whole text: kinds of bytes and of pairs of bytes, lengths,
repetition of words and lines. They are computed by Spark; the fit on the driver sees the
features of at most ``max_positive`` and ``max_unlabelled`` texts, the first in the order of
a hash of their ids. Both bounds are parameters.

Null texts are empty; empty texts have features and a score like any other. Without trusted
positives every score is 0.5. Equal texts get equal scores; an empty table gives an empty
one. Of further columns only ``carry`` is kept.
"""

from __future__ import annotations

import warnings
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fields_of, texts

# fixed values: kinds of bytes; each byte has the number of its kind, others are 0
KINDS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ",
         b"\n", b"\t\r\x0b\x0c", b".", b",;:", b"!?", b"#*$%&", b"|<>", b"'\"()[]{}-_/\\@+=~^`",
         bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0x100))]
KIND = np.zeros(256, np.int64)
for _number, _bytes in enumerate(KINDS, 1):
    KIND[list(_bytes)] = _number
N_KINDS = len(KINDS) + 1
N_FEATURES = N_KINDS + N_KINDS * N_KINDS + 10


def features(text: bytes) -> np.ndarray:
    """Counts over the whole text, as shares and logarithms."""
    kinds = KIND[np.frombuffer(text, np.uint8)]
    single = np.bincount(kinds, minlength=N_KINDS)
    pairs = np.bincount(kinds[:-1] * N_KINDS + kinds[1:], minlength=N_KINDS * N_KINDS) if len(
        kinds) else np.zeros(N_KINDS * N_KINDS)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    n, count = max(1, len(words)), Counter(words)
    following = sum(a == b for a, b in zip(words, words[1:], strict=False))
    more = [np.log1p(len(text)) / 10, np.log1p(len(words)) / 8, len(text) / n / 20,
            len(count) / n, max(count.values(), default=0) / n, following / n,
            (len(lines) - len(set(lines))) / max(1, len(lines)),
            np.log1p(len(lines)) / 6, np.log1p(len(text) / max(1, len(lines))) / 8,
            np.log1p(max(map(len, words), default=0)) / 6]
    size = max(1, len(text))
    return np.concatenate([np.sqrt(single / size), np.sqrt(pairs / size), more]).astype(np.float32)


class Net:
    """One hidden layer over standardized features."""

    def __init__(self, x: np.ndarray, hidden: int = 12, seed: int = 5):
        rng = np.random.default_rng(seed)
        # a small floor keeps features that hardly vary in the sample from growing large
        self.mean, self.scale = x.mean(0), 1 / (x.std(0) + .02)
        self.w = [rng.standard_normal((x.shape[1], hidden)) / np.sqrt(x.shape[1]), np.zeros(hidden),
                  rng.standard_normal(hidden) / np.sqrt(hidden), np.zeros(1)]

    def ready(self, x):
        return np.clip((x - self.mean) * self.scale, -8, 8).astype(np.float64)

    def logit(self, x) -> np.ndarray:
        """Of standardized features."""
        return np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3][0]

    def score(self, x) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(self.ready(x))))

    def gradient(self, x, slope):
        a = np.tanh(x @ self.w[0] + self.w[1])
        d = slope[:, None] * self.w[2] * (1 - a * a)
        return [x.T @ d, d.sum(0), a.T @ slope, slope.sum(keepdims=True)]


def fit(positive, unlabelled, prior: float, steps: int = 1500, batch: int = 256,
        seed: int = 5) -> Net:
    """Minimises the non-negative risk with logistic loss by Adam."""
    rng = np.random.default_rng(seed)
    net = Net(np.concatenate([positive, unlabelled]), seed=seed)
    p_all, u_all = net.ready(positive), net.ready(unlabelled)
    m = [np.zeros_like(w) for w in net.w]
    v = [np.zeros_like(w) for w in net.w]
    for t in range(1, steps + 1):
        p = p_all[rng.integers(0, len(p_all), batch)]
        u = u_all[rng.integers(0, len(u_all), batch)]
        gp, gu = net.logit(p), net.logit(u)
        sp, su = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        x, slope_neg = np.concatenate([u, p]), np.concatenate([su, -prior * sp]) / batch
        if negative >= 0:
            slope = slope_neg + np.concatenate([np.zeros(batch), prior * (sp - 1) / batch])
        else:  # the part that cannot be negative in truth is turned back
            slope = -slope_neg
        grad = net.gradient(x, slope)
        for k, g in enumerate(grad):
            g = g + 1e-4 * net.w[k] * (k in (0, 2))
            m[k] = .9 * m[k] + .1 * g
            v[k] = .999 * v[k] + .001 * g * g
            net.w[k] = net.w[k] - .005 * (m[k] / (1 - .9 ** t)) / (np.sqrt(v[k] / (1 - .999 ** t)) + 1e-8)
    return net


def estimate_prior(positive_scores, unlabelled_scores) -> float:
    """Smallest ratio of the tail shares, with an allowance for sampling error."""
    p, u = np.sort(positive_scores), np.sort(unlabelled_scores)
    bounds = np.quantile(p, np.linspace(0, .9, 91))
    p_tail = 1 - np.searchsorted(p, bounds, "left") / len(p)
    u_tail = 1 - np.searchsorted(u, bounds, "left") / len(u)
    error = np.sqrt(u_tail * (1 - u_tail) / len(u) + p_tail * (1 - p_tail) / len(p))
    return float(np.clip(((u_tail + error) / p_tail).min(), .05, .99))


def train(positive, unlabelled) -> Net | None:
    if not len(positive) or not len(unlabelled):
        return None
    half = len(positive) // 2
    if half:
        first = fit(positive[:half], unlabelled, .5, steps=600)
        prior = estimate_prior(first.score(positive[half:]), first.score(unlabelled))
    else:
        prior = .5
    return fit(positive, unlabelled, prior)


def feature_rows(docs: DataFrame, text: str, carry: tuple[str, ...]) -> DataFrame:
    schema = docs.select(*carry).schema
    for field in fields_of("features array<float>"):
        schema = schema.add(field)

    def run(batches):
        for batch in batches:
            made = [features(t) for t in texts(batch.column(len(carry)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in range(len(carry))]
                + [pa.array(made, pa.list_(pa.float32()))], schema.names)

    return docs.select(*carry, F.col(text).alias("__text")).mapInArrow(run, schema)


def score_documents(docs: DataFrame, labelled: DataFrame, unlabelled: DataFrame | None = None,
                    key: str = "doc_id", label: str = "quality", text: str = "text",
                    carry: tuple[str, ...] = ("doc_id",), max_positive: int = 4000,
                    max_unlabelled: int = 8000) -> DataFrame:
    """Adds ``score`` of every whole text. ``labelled`` (key, label) names the trusted
    positives by label 1, other labels are not used; ``unlabelled`` (default: ``docs``) gives
    the web text."""
    order = F.xxhash64(key)
    trusted = (labelled.where((F.col(label) == 1) & F.col(key).isNotNull()).select(key).distinct()
               .join(docs.select(key), key, "left_semi").orderBy(order, key).limit(max_positive))
    web = ((docs if unlabelled is None else unlabelled).select(key).where(F.col(key).isNotNull())
           .distinct().orderBy(F.xxhash64(F.lit(1), key), key).limit(max_unlabelled))
    # both lists are bounded by parameters
    ids = (trusted.withColumn("positive", F.lit(1)).unionByName(web.withColumn("positive", F.lit(0))))
    chosen = docs.join(F.broadcast(ids.groupBy(key).agg(
        F.max("positive").alias("p"), F.min("positive").alias("u"))), key)
    found = chosen.select(F.col(key).alias("k"), F.col("p"), F.col("u"), F.col(text).alias("t"))
    # of repeated ids the samples hold each row; the order makes the fit repeatable
    rows = sorted((tuple(r) for r in feature_rows(found, "t", ("k", "p", "u"))
                   .orderBy("k").limit(max_positive + max_unlabelled).collect()),
                  key=lambda r: (r[0], r[3]))
    pick = lambda ok: np.array([r[3] for r in rows if ok(r)], np.float32).reshape(-1, N_FEATURES)
    net = train(pick(lambda r: r[1] == 1), pick(lambda r: r[2] == 0))
    if net is None:
        warnings.warn("quality: no trusted or no unlabelled document; every score is 0.5",
                      stacklevel=2)
    kept = docs.select(*carry, F.col(text).alias("__text"))
    if net is None:
        return kept.drop("__text").withColumn("score", F.lit(0.5))
    schema = docs.select(*carry).schema
    for field in fields_of("score double"):
        schema = schema.add(field)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # some KB whatever the input

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                x = np.stack([features(t) for t in texts(batch.column(len(carry)))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in range(len(carry))]
                    + [pa.array(shared.value.score(x))], schema.names)

    return kept.mapInArrow(run, schema)

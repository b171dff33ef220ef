"""Toxicity scores from a bidirectional gated recurrent network (operator 6).

A word enters as the mean of its character 4-grams' embeddings and an embedding of the whole
word (both hashed), with the log odds of its 4-grams and of itself among labelled texts. Two
gated recurrent layers read a window of words in both directions, attention pools their
states, and a logistic output scores the window. All overlapping windows of a text are
scored; the text has the score of its highest window.

Labels are given for whole texts, so training is by multiple instances: in each epoch the
window that scores highest stands for its text (at first the one with the highest log odds),
with random windows of clean texts as further negatives. The log odds a text is trained with
come from the half of the sample that it is not in. Training is on the driver, on a sample of
at most ``per_class`` texts of each label and ``max_chars`` characters each; both bounds are
parameters. Scoring reads whole texts.

Null and empty texts, and texts without a word, are one window of padding. Without texts of
both labels to learn from, every score is 0. Equal texts get equal scores, whatever their
other columns; an empty table gives an empty one. Of further columns only ``carry`` is kept.
"""

from __future__ import annotations

import re
import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fields_of, hidden, sent, shown

WORDS, STRIDE = 32, 24
BUCKETS, EMBED, HIDDEN = 1 << 15, 8, 8
INPUT = 2 * EMBED + 3
PAD = -1
REMEMBERED = 200_000  # words of which a task keeps the projections, and as many older ones
TRIM = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def bare_words(text: str) -> list[str]:
    return (text or "").lower().split()


def spell(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the character 4-grams of all words, where those of each word start, and a
    hash of each whole word. Marks and digits at the ends of a word do not count."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    trim = TRIM.sub
    parts = [(w if w.isalpha() else trim("", w)).encode() for w in words]
    buffer = np.frombuffer(b"".join(b"<" + p + b">>>" for p in parts), np.uint8)
    length = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(length + 4)
    grams = length + 1
    starts = np.cumsum(grams) - grams
    at = np.arange(starts[-1] + grams[-1]) + np.repeat(ends - length - 4 - starts, grams)
    b = buffer.astype(np.uint64)
    value = b[at] | b[at + 1] << np.uint64(8) | b[at + 2] << np.uint64(16) | b[at + 3] << np.uint64(24)
    mixed = value * np.uint64(0x9E3779B97F4A7C15)
    ids = (mixed >> np.uint64(64 - 15)).astype(np.int64)
    whole = np.add.reduceat(mixed * (np.arange(len(at), dtype=np.uint64)
                                     - np.repeat(starts, grams).astype(np.uint64)
                                     + np.uint64(0x632BE59BD9B4E019)), starts)
    return ids, starts, (whole * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - 15)).astype(np.int64)


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Network:
    """Weights, and the passes forward and back."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        h = HIDDEN
        self.w = {"chars": normal(BUCKETS, EMBED, scale=.1),
                  "words": normal(BUCKETS, EMBED, scale=.1),
                  "U": normal(2 * h, h, scale=.4), "v": normal(h, scale=.4),
                  "o": normal(2 * h, scale=.4), "c": np.full(1, -1, np.float32)}
        for d in "fb":
            self.w["W" + d] = normal(INPUT, 3 * h, scale=.35)
            self.w["R" + d] = normal(h, 3 * h, scale=.35)
            self.w["k" + d] = np.zeros(3 * h, np.float32)
        self.odds = (np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32))

    def inputs(self, ids, starts, whole, odds=None) -> np.ndarray:
        """One input vector per word."""
        chars, words = odds or self.odds
        if not len(starts):
            return np.zeros((0, INPUT), np.float32)
        n = np.diff(np.append(starts, len(ids)))[:, None].astype(np.float32)
        gram = chars[ids]
        return np.concatenate([
            np.add.reduceat(self.w["chars"][ids], starts, axis=0) / n, self.w["words"][whole],
            np.maximum.reduceat(gram, starts)[:, None], np.add.reduceat(gram, starts)[:, None] / n,
            words[whole][:, None]], axis=1)

    def layer(self, d: str, projected, mask, keep=False):
        """States (words, windows, hidden) of one direction; projected: (words, windows, 3h)."""
        h, steps = HIDDEN, range(WORDS) if d == "f" else range(WORDS - 1, -1, -1)
        state = np.zeros((projected.shape[1], h), np.float32)
        states, kept = np.empty((WORDS, *state.shape), np.float32), {}
        R = self.w["R" + d]
        for t in steps:
            x, rec = projected[t], state @ R
            gates = sigmoid(x[:, :2 * h] + rec[:, :2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h:] + r * rec[:, 2 * h:])
            if keep:
                kept[t] = (state, z, r, new, rec[:, 2 * h:])
            state = (new + z * (state - new)) * mask[t]
            states[t] = state
        return states, kept

    def pool(self, both, mask):
        """Attention over the words of each window."""
        a = np.tanh(both @ self.w["U"])
        e = np.where(mask[..., 0] > 0, a @ self.w["v"], -30)
        e = np.exp(e - e.max(0))
        weight = (e / e.sum(0))[..., None]
        return a, weight, (weight * both).sum(0)

    def logits(self, projections, rows) -> np.ndarray:
        """Scores of windows. projections: of each word for both directions, the last row for
        padding; rows: (windows, words), PAD for none."""
        out = np.empty(len(rows), np.float32)
        for at in range(0, len(rows), 2048):
            part = rows[at:at + 2048].T
            mask = (part != PAD)[..., None].astype(np.float32)
            both = np.concatenate([
                self.layer(d, p[part], mask)[0] for d, p in zip("fb", projections, strict=True)], 2)
            out[at:at + 2048] = self.pool(both, mask)[2] @ self.w["o"] + self.w["c"][0]
        return out

    def project(self, x) -> list[np.ndarray]:
        x = np.concatenate([x, np.zeros((1, INPUT), np.float32)])
        return [x @ self.w["W" + d] + self.w["k" + d] for d in "fb"]

    def step(self, x, rows, target, weight):
        """Loss gradient by the weights and by the inputs (windows, words, INPUT)."""
        h, g = HIDDEN, {}
        part = rows.T
        mask = (part != PAD)[..., None].astype(np.float32)
        seq = np.concatenate([x, np.zeros((1, INPUT), np.float32)])[part]
        runs = {d: self.layer(d, seq @ self.w["W" + d] + self.w["k" + d], mask, True) for d in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], 2)
        a, share, pooled = self.pool(both, mask)
        p = sigmoid(pooled @ self.w["o"] + self.w["c"][0])
        err = ((p - target) * weight / weight.sum()).astype(np.float32)
        g["c"], g["o"] = err.sum(keepdims=True), pooled.T @ err
        d_pooled = err[:, None] * self.w["o"]
        d_both = share * d_pooled
        d_share = (both * d_pooled).sum(2)
        d_e = share[..., 0] * (d_share - (share[..., 0] * d_share).sum(0))
        g["v"] = np.einsum("tb,tbh->h", d_e, a)
        d_a = d_e[..., None] * self.w["v"] * (1 - a * a)
        g["U"] = np.einsum("tbi,tbh->ih", both, d_a)
        d_both = d_both + d_a @ self.w["U"].T
        d_seq = np.zeros_like(seq)
        for k, d in enumerate("fb"):
            W, R = self.w["W" + d], self.w["R" + d]
            g["W" + d], g["R" + d], g["k" + d] = np.zeros_like(W), np.zeros_like(R), 0
            carry = 0
            for t in (range(WORDS - 1, -1, -1) if d == "f" else range(WORDS)):
                state, z, r, new, rec = runs[d][1][t]
                d_state = (d_both[t, :, k * h:(k + 1) * h] + carry) * mask[t]
                d_new = d_state * (1 - z) * (1 - new * new)
                d_z = d_state * (state - new) * z * (1 - z)
                d_r = d_new * rec * r * (1 - r)
                d_x = np.concatenate([d_z, d_r, d_new], 1)
                d_rec = np.concatenate([d_z, d_r, d_new * r], 1)
                carry = d_state * z + d_rec @ R.T
                g["W" + d] += seq[t].T @ d_x
                g["R" + d] += state.T @ d_rec
                g["k" + d] = g["k" + d] + d_x.sum(0)
                d_seq[t] += d_x @ W.T
        return g, d_seq


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping windows over texts whose words lie one after the other: rows of positions
    (PAD past the end of a text), and the text of each. At least one window a text."""
    per = np.maximum(1, -(-(counts - WORDS) // STRIDE) + 1)
    text = np.repeat(np.arange(len(counts)), per)
    begin = (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)) * STRIDE
    first = np.cumsum(counts) - counts
    inside = begin[:, None] + np.arange(WORDS)
    return np.where(inside < counts[text][:, None], first[text][:, None] + inside, PAD), text


def log_odds(bucket_rows, labels, prior: float = 2.0) -> np.ndarray:
    """Log odds of each bucket's texts, drawn towards 0 where they are few."""
    toxic, clean = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for buckets, label in zip(bucket_rows, labels, strict=True):
        (toxic if label else clean)[buckets] += 1
    n, m = max(1, sum(labels)), max(1, len(labels) - sum(labels))
    base = n / m
    odds = np.log((toxic + prior * base) / (clean * base + prior * base))
    return np.clip(odds, -3, 3).astype(np.float32)


def train(texts: list[str], labels: list[int], steps: int = 900, batch: int = 64,
          seed: int = 7) -> Network | None:
    """A network fitted to texts and their labels; none without both labels."""
    labels = np.array(labels, np.int64)
    if not 0 < labels.sum() < len(labels):
        return None
    rng, net = np.random.default_rng(seed), Network(seed)
    # words as numbers from the start: as objects they would take ten times the texts
    number: dict[str, int] = {}
    words = [np.array([number.setdefault(w, len(number)) for w in bare_words(t)], np.int64)
             for t in texts]
    counts = np.array([len(ws) for ws in words])
    position = np.concatenate(words)
    ids, starts, whole = spell(list(number))
    del number
    n_grams = np.diff(np.append(starts, len(ids)))
    rows, owner = windows(counts)

    grams_of = np.split(ids, starts[1:]) if len(starts) else []
    per_text = [(np.unique(np.concatenate([grams_of[w] for w in ws])).astype(np.int32),
                 np.unique(whole[ws]).astype(np.int32)) if len(ws)
                else (np.zeros(0, np.int32),) * 2 for ws in map(np.unique, words)]
    half = rng.permutation(len(texts)) % 2

    def odds_of(chosen):
        chosen = np.flatnonzero(chosen)
        return tuple(log_odds([per_text[i][k] for i in chosen], labels[chosen].tolist())
                     for k in (0, 1))

    split = [odds_of(half == 1), odds_of(half == 0)]  # by the half of the text itself
    net.odds = odds_of(half >= 0)
    del per_text, grams_of, words
    # words as each half sees them: first those with the odds for half 0, then for half 1
    n_words = len(starts)
    row_words = np.where(rows == PAD, PAD, position[rows] if len(position) else PAD)
    row_words = np.where(row_words == PAD, PAD, row_words + (half[owner] * n_words)[:, None])
    seen = lambda: np.concatenate([net.inputs(ids, starts, whole, o) for o in split])

    x = seen()
    hint = np.append(x[:, -1] + x[:, -3], -9)[row_words].max(1)
    moments: dict = {}

    def adam(key, grad, rate=.01):
        m, v, t = moments.get(key, (0, 0, 0))
        m, v, t = .9 * m + .1 * grad, .999 * v + .001 * grad * grad, t + 1
        moments[key] = (m, v, t)
        net.w[key] -= (rate * (m / (1 - .9 ** t)) / (np.sqrt(v / (1 - .999 ** t)) + 1e-6)).astype(np.float32)

    squares = {k: np.full(BUCKETS, 1e-4, np.float32) for k in ("chars", "words")}
    positive = labels.sum()
    class_weight = np.where(labels == 1, .5 / positive, .5 / (len(labels) - positive)) * len(labels)
    done = epoch = 0
    while done < steps:
        if epoch and epoch % 2 == 1:
            x = seen()
            hint = net.logits(net.project(x), row_words)
        order = np.lexsort((hint, owner))
        best = order[np.append(np.flatnonzero(np.diff(owner[order])), len(order) - 1)]
        clean = np.flatnonzero(labels[owner] == 0)
        chosen = np.concatenate([best, rng.choice(clean, min(len(clean), len(best)), False)])
        chosen = rng.permutation(chosen)
        for at in range(0, len(chosen), batch):
            part = chosen[at:at + batch]
            text = owner[part]
            used, local = np.unique(row_words[part], return_inverse=True)
            local = local.reshape(len(part), WORDS)
            if used[0] == PAD:
                used, local = used[1:], local - 1
            # inputs of the words of this batch only
            own, side = used % max(1, n_words), used // max(1, n_words)
            uniq, where = np.unique(own, return_inverse=True)
            spread = n_grams[uniq]
            sub_starts = np.cumsum(spread) - spread
            sub_ids = ids[np.arange(spread.sum()) + np.repeat(starts[uniq] - sub_starts, spread)]
            xs = np.stack([net.inputs(sub_ids, sub_starts, whole[uniq], o) for o in split])
            xb = xs[side, where.reshape(-1)]
            g, d_seq = net.step(xb, local, labels[text], class_weight[text])
            for key, grad in g.items():
                adam(key, grad)
            flat = local.T.reshape(-1)
            ok = flat != PAD
            d_x = np.zeros((len(used), INPUT), np.float32)
            np.add.at(d_x, flat[ok], d_seq.reshape(-1, INPUT)[ok])
            d_u = np.zeros((len(uniq), INPUT), np.float32)
            np.add.at(d_u, where.reshape(-1), d_x)
            d_gram = np.repeat(d_u[:, :EMBED] / spread[:, None], spread, axis=0)
            for key, at_rows, grad in (("chars", sub_ids, d_gram),
                                       ("words", whole[uniq], d_u[:, EMBED:2 * EMBED])):
                touched, back = np.unique(at_rows, return_inverse=True)
                total = np.zeros((len(touched), EMBED), np.float32)
                np.add.at(total, back.reshape(-1), grad)
                squares[key][touched] += (total * total).mean(1)
                net.w[key][touched] -= .05 * total / np.sqrt(squares[key][touched])[:, None]
            done += 1
        epoch += 1
    return net


class Scorer:
    """Scores batches of texts; the projections of recent words are remembered."""

    def __init__(self, net: Network, limit: int = REMEMBERED):
        self.net, self.limit, self.known, self.old = net, limit, {}, {}

    def __call__(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > self.limit:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        words = [bare_words(t) for t in texts]
        number = dict.fromkeys(w for ws in words for w in ws)
        missing = []
        for w in number:
            if w not in known:
                if w in old:
                    known[w] = old[w]
                else:
                    missing.append(w)
        for at in range(0, len(missing), 20_000):
            part = missing[at:at + 20_000]
            x = self.net.inputs(*spell(part))
            both = np.concatenate([x @ self.net.w["W" + d] + self.net.w["k" + d] for d in "fb"], 1)
            raw, width = both.tobytes(), both.shape[1] * 4
            known.update((w, raw[i * width:(i + 1) * width]) for i, w in enumerate(part))
        table = np.frombuffer(b"".join([known[w] for w in number]), np.float32).reshape(-1, 6 * HIDDEN)
        pad = np.concatenate([self.net.w["kf"], self.net.w["kb"]])[None]
        table = np.concatenate([table, pad])
        for i, w in enumerate(number):
            number[w] = i
        counts = np.array([len(ws) for ws in words], np.int64)
        position = np.array([number[w] for ws in words for w in ws] + [PAD], np.int64)
        rows, owner = windows(counts)
        projections = [np.ascontiguousarray(table[:, :3 * HIDDEN]),
                       np.ascontiguousarray(table[:, 3 * HIDDEN:])]
        logit = self.net.logits(projections, position[rows])
        first = np.searchsorted(owner, np.arange(len(texts)))
        return sigmoid(np.maximum.reduceat(logit, first).astype(np.float64))


def training_sample(docs: DataFrame, labelled: DataFrame, key: str, label: str, text: str,
                    per_class: int, max_chars: int) -> DataFrame:
    """At most ``per_class`` texts of each label, the first in the order of a hash of the
    key, among the labelled documents that are there. ``labelled``: (key, label); of repeated
    keys the highest label counts."""
    usable = (docs.select(key, F.col(text).alias("text"))
              .where(F.col("text").isNotNull() & (F.length("text") <= max_chars)))
    rows = (labelled.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
            .groupBy(key).agg(F.max(label).alias(label)).join(usable.select(key), key, "left_semi"))
    order = F.xxhash64(key)
    ids = [rows.where(F.col(label) == v).orderBy(order, key).limit(per_class) for v in (0, 1)]
    # at most 2 * per_class rows of two numbers
    found = usable.join(F.broadcast(ids[0].unionByName(ids[1])), key)
    tops = [found.where(F.col(label) == v).orderBy(order, key, "text").limit(per_class) for v in (0, 1)]
    return tops[0].unionByName(tops[1]).select("text", label)


def score_documents(docs: DataFrame, labelled: DataFrame, key: str = "doc_id",
                    label: str = "toxic", text: str = "text",
                    carry: tuple[str, ...] = ("doc_id",), per_class: int = 1500,
                    max_chars: int = 20_000, net: Network | None = None,
                    remembered: int = REMEMBERED) -> DataFrame:
    """Adds ``score`` (0 to 1) of every whole text. Learns from ``labelled`` (key, label)
    unless a trained ``net`` is given."""
    if net is None:
        sample = sorted(map(tuple, training_sample(
            docs, labelled, key, label, text, per_class, max_chars).collect()))
        net = train([t for t, _ in sample], [v for _, v in sample])
        del sample
        if net is None:
            warnings.warn("toxicity: no document of one of the labels; every score is 0",
                          stacklevel=2)
    if net is None:
        return docs.select(*carry).withColumn("score", F.lit(0.0))
    kept, place = sent(docs, carry, text)
    schema = docs.select(*carry).schema
    for field in fields_of("score double"):
        schema = schema.add(field)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # 2 MB whatever the input

    def run(batches):
        score = Scorer(shared.value, remembered)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = score(batch.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in range(len(carry))] + [pa.array(found)], schema.names)

    return kept.mapInArrow(run, schema)


def clean_documents(docs: DataFrame, labelled: DataFrame, bound: float = 0.5,
                    key: str = "doc_id", label: str = "toxic", text: str = "text",
                    net: Network | None = None, remembered: int = REMEMBERED) -> DataFrame:
    """The documents that score below ``bound``, all columns as they were."""
    rows = hidden(docs)
    learn = labelled.select(F.col(key).alias(f"in_{key}"), F.col(label).alias("__label"))
    scored = score_documents(rows, learn, f"in_{key}", "__label", f"in_{text}",
                             tuple(rows.columns), net=net, remembered=remembered)
    return shown(scored.where(F.col("score") < bound), docs)

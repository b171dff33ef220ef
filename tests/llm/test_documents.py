"""Rules, classifiers, scores, near duplicates and shards on small tables."""

import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tubetrace.llm import embed_dedup, minhash, ppm, pu_quality, quality_rules, sharding, toxicity
from tubetrace.llm.common import components


def brute_repeats(words):
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    return len({i + j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for j in range(8)})


@pytest.mark.parametrize("seed", range(30))
def test_repeated_words(seed):
    rng = np.random.default_rng(seed)
    words = [b"%d" % x for x in rng.integers(0, 3, rng.integers(0, 120))]
    assert quality_rules.repeated_words(words) == brute_repeats(words)


def test_quality_rules(odd, none):
    rows = quality_rules.judge_documents(odd).collect()
    assert len(rows) == odd.count() and not any(r.kept for r in rows if r.n_words < 20)
    prose = "A quiet line of plain words that ends well. " * 1 + " ".join(f"w{i}" for i in range(30)) + "."
    shout = "\n".join("THIS LOUD LINE HAS NUMBER %d!!" % i for i in range(40))
    table = "\n".join("a%d | b%d | c%d | d%d" % (i, i, i, i) for i in range(40))
    verdict = [quality_rules.judge(t.encode())[6] for t in (prose, shout, table, prose + "\nprivacy policy")]
    assert verdict == [True, False, False, True]
    assert quality_rules.judge((prose + "\nprivacy policy").encode())[-1] == prose.encode()
    kept = quality_rules.kept_documents(odd)
    assert kept.columns == odd.columns and quality_rules.kept_documents(none).count() == 0


def test_sentences_may_end_in_marks_of_any_script():
    for word, mark, kept in (("शब्द", "।", True), ("كلمة", "؟", True), ("词", "。", True), ("शब्द", "", False)):
        line = " ".join(f"{word}{i}" for i in range(60)) + mark
        assert quality_rules.line_fails(line.encode(), line.encode().split()) is not kept


def test_training_samples_hold_the_documents_that_are_there(spark_llm):
    # far more labels than documents
    docs = spark_llm.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    labels = spark_llm.range(-100_000, 100_000).selectExpr("id as doc_id", "int(id % 2 = 0) as toxic")
    sample = toxicity.training_sample(docs, labels, "doc_id", "toxic", "text", 30, 1000).collect()
    assert sorted(r.toxic for r in sample) == [0] * 20 + [1] * 20


def test_an_empty_class_is_told(spark_llm):
    docs = spark_llm.createDataFrame([(1, "a text")], "doc_id long, text string")
    labels = spark_llm.createDataFrame([(1, 0), (9, 1)], "doc_id long, label int")
    with pytest.warns(UserWarning, match="every score is 0"):
        toxicity.score_documents(docs, labels, label="label")
    with pytest.warns(UserWarning, match="every score is 0.5"):
        pu_quality.score_documents(docs, labels, label="label")


def toxic_sample(n=60):
    rng = np.random.default_rng(1)
    base = ["river", "stone", "cloud", "walks", "green", "over", "paper", "light", "seven", "house"]
    texts, labels = [], []
    for i in range(n):
        words = rng.choice(base, 40).tolist()
        if i % 2:
            words[int(rng.integers(40))] = "gruk" + rng.choice(["en", "ish", "a"])
        texts.append(" ".join(words))
        labels.append(i % 2)
    return texts, labels


def test_toxicity_learns_and_scores(spark_llm, odd, none):
    texts, labels = toxic_sample()
    net = toxicity.train(texts, labels, steps=150)
    held, truth = toxic_sample(80)
    scores = toxicity.Scorer(net)(held)
    assert np.mean((scores >= .5) == np.array(truth)) > .95
    long = " ".join(["river stone cloud"] * 2000)
    far = toxicity.Scorer(net)([long, long + " grukish " + long, "", None])
    assert far[1] > .5 > far[0] and far[2] == far[3]
    rows = toxicity.score_documents(odd, None, net=net).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_documents(none, None, net=net).count() == 0
    labelled = spark_llm.createDataFrame([(0, None), (None, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_documents(odd, labelled).collect()} == {0.0}
    clean = toxicity.clean_documents(odd, labelled, net=net)
    assert clean.columns == odd.columns


def test_toxicity_gradient():
    net, rng = toxicity.Network(3), np.random.default_rng(3)
    x = rng.standard_normal((20, toxicity.INPUT)).astype(np.float32)
    rows = rng.integers(0, 20, (4, toxicity.WORDS))
    rows[0, 5:] = toxicity.PAD
    y, w = np.array([1, 0, 1, 0]), np.ones(4)

    def loss():
        z = net.logits(net.project(x), rows).astype(float)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    grads, _ = net.step(x, rows, y, w)
    for key, at in (("Wf", (3, 5)), ("Rb", (2, 20)), ("U", (4, 1)), ("v", (2,)), ("o", (3,)), ("kb", (9,))):
        old, eps = net.w[key][at], 1e-2
        net.w[key][at] = old + eps
        up = loss()
        net.w[key][at] = old - eps
        slope = (up - loss()) / (2 * eps)
        net.w[key][at] = old
        assert grads[key][at] == pytest.approx(slope, rel=.05, abs=2e-4)


def test_windows_overlap_and_cover():
    for n in (0, 1, 31, 32, 33, 56, 57, 200):
        rows, owner = toxicity.windows(np.array([3, n]))
        own = rows[owner == 1]
        assert set(own[own != toxicity.PAD]) == set(range(3, 3 + n)) and len(own) >= 1


def test_pu_quality(spark_llm, odd, none):
    rng = np.random.default_rng(0)
    good = [" ".join(f"word{k}" for k in rng.integers(0, 500, 60)) + "." for _ in range(150)]
    bad = [" ".join("$$$ ###" for _ in range(60)) for _ in range(50)]
    x = np.stack([pu_quality.features(t.encode()) for t in good + bad])
    rest = np.concatenate([x[75:150], x[150:]])
    first = pu_quality.fit(x[:40], rest, .5, steps=300)
    assert pu_quality.estimate_prior(first.score(x[40:75]), first.score(rest)) == pytest.approx(.6, abs=.15)
    net = pu_quality.train(x[:75], rest)
    assert (net.score(x[75:150]) >= .5).mean() > .95 and (net.score(x[150:]) < .5).mean() > .95
    labels = spark_llm.createDataFrame([(3, 1), (7, 1), (4, 0), (99, 1), (3, 1)], "doc_id long, quality int")
    rows = pu_quality.score_documents(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in pu_quality.score_documents(odd, labels.where("quality = 0")).collect()} == {.5}
    assert pu_quality.score_documents(none, labels).count() == 0


def test_ppm_against_brute_force(spark_llm, odd, none):
    order = ppm.ORDER
    rows = {r.doc_id: r for r in ppm.score_documents(odd, F.col("doc_id") % 2 == 1, frequent=4).collect()
            if r.doc_id is not None}
    docs = odd.collect()
    tokens = lambda t: (t or "").encode().translate(ppm.TO_LOWER).split()
    train = [tokens(d.text) for d in docs if d.doc_id is not None and d.doc_id % 2]
    counts = Counter(w for t in train for w in [*t, None])
    total, types = sum(counts.values()), len(counts)
    seen = [defaultdict(Counter) for _ in range(order + 1)]
    for t in train:
        b = bytes(order) + b" ".join(t) + b"\xff"
        for j in range(order, len(b)):
            for k in range(order + 1):
                seen[k][b[j - k:j]][b[j]] += 1

    def cost(b, j):
        out, p = set(), 1.0
        for k in range(order, -1, -1):
            m = {s: n for s, n in seen[k].get(b[j - k:j], {}).items() if s not in out}
            if m:
                t = sum(m.values())
                if b[j] in m:
                    return math.log10(p * (2 * m[b[j]] - 1) / (2 * t))
                p *= len(m) / (2 * t)
                out |= set(m)
        return math.log10(p / (256 - len(out)))

    for d in docs:
        if d.doc_id is None or len(d.text or "") > 10_000:
            continue
        words, r = [*tokens(d.text), None], rows[d.doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(w in counts for w in words), total)
        assert r.base_score == pytest.approx(base)
        b = bytes(order) + b" ".join(words[:-1]) + b"\xff"
        assert r.score == pytest.approx(sum(cost(b, j) for j in range(order, len(b))), abs=1e-3, rel=1e-4)
    assert ppm.score_documents(none, F.lit(True)).count() == 0
    untaught = ppm.score_documents(odd, F.lit(False)).first()
    assert untaught.n_known == 0 and untaught.train_tokens == 0


@pytest.mark.parametrize("capacity", [0, 40])
def test_ppm_uses_the_contexts_outside_the_shared_trie(spark_llm, odd, capacity):
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ab c"), 30)) for _ in range(40)] + ["zzzzzz \u00e9 abcabcab", ""]
    rows = [(i, t) for i, t in enumerate(texts)]
    small = spark_llm.createDataFrame(rows, "doc_id long, text string")
    for docs in (small, odd.where("doc_id is not null").select("doc_id", "text")):
        training = F.col("doc_id") % 3 != 1
        want = {r.doc_id: r.score for r in ppm.score_documents(docs, training).distinct().collect()}
        found = ppm.score_documents(docs, training, capacity=capacity).distinct().collect()
        assert len(found) == len(want)
        for r in found:
            assert r.score == pytest.approx(want[r.doc_id], abs=1e-3, rel=1e-4)


def test_ppm_shares_the_same_contexts_of_a_corpus_of_any_size(spark_llm):
    keys, _ = ppm.gram_keys([b"common words", b"rare ones"])
    weight = np.where(np.arange(len(keys)) < 13, 1 << 22, 1)
    outside = []
    for times in (1, 5):
        counts = spark_llm.createDataFrame(
            [(None, int(k), int(n) * times) for k, n in zip(keys, weight, strict=True)],
            "word binary, gram long, n long")
        trie, _, contexts = ppm.build_trie(counts, ppm.CAPACITY)
        assert not trie.whole
        outside.append({r.context for r in contexts.collect()})
    assert outside[0] == outside[1]
    text = lambda c: int(c).to_bytes(6, "big").lstrip(b"\0")[1:]
    assert b"rare " in set(map(text, outside[0])) and b"commo" not in set(map(text, outside[0]))


def test_ppm_numbers_words_and_counts_open_ones_per_text():
    rows = [None, "", " \n", "A b  a\tB", "É é\x1c x ", "z" * 90, "a a A b"]
    bodies, distinct, codes, ends = ppm.tokens(pa.array(rows, pa.large_string())[1:])
    want = [(t or "").encode().translate(ppm.TO_LOWER).split() for t in rows[1:]]
    assert ppm.texts(bodies) == [b" ".join(t) for t in want]
    found = np.split(np.array(distinct.to_pylist(), object)[codes], ends[:-1])
    assert [t.tolist() for t in found] == [[*t, ppm.END_WORD] for t in want]
    assert len(set(distinct.to_pylist())) == len(distinct)
    # a text sends each of its rare words and open contexts once, with their number
    rng = np.random.default_rng(3)
    owners, values = rng.integers(0, 5, 400) // 2 * 2, rng.integers(0, 9, 400)
    o, v, n = ppm.counted(owners, values)
    assert list(zip(o, v, n, strict=True)) == sorted(
        (*pair, n) for pair, n in Counter(zip(owners, values, strict=True)).items())
    made = ppm.lists(o, 5, {"key": pa.array(v), "times": pa.array(n)}).to_pylist()
    assert [sum(i["times"] for i in row) for row in made] == np.bincount(owners, minlength=5).tolist()
    assert [len(x) for x in ppm.counted(owners[:0], values[:0])] == [0, 0, 0]


def test_ppm_probabilities_add_up():
    keys, _ = ppm.gram_keys([b"abracadabra", b"abrakadabra", b""])
    grams = Counter(int(k) for s in range(1, ppm.ORDER + 2) for k in ppm.shorter(keys, s))
    trie = ppm.Trie(np.array(list(grams)), np.array(list(grams.values())))
    for context in (b"dabra", b"zzzzz", b"zzabr", bytes(5)):
        start = int.from_bytes(b"\x01" + context) << 8
        p = 10 ** trie.log_probabilities(start + np.arange(256)).astype(float)
        assert p.sum() == pytest.approx(1, abs=1e-4)


def brute_groups(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_components(spark_llm):
    edges = [(1, 2), (3, 2), (5, 4), (9, 9), (6, 7), (7, 8), (8, 1), (4, 5)]
    df = spark_llm.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 6: 1, 7: 1, 8: 1, 4: 4, 5: 4}
    assert components(df.limit(0)).count() == 0


def test_minhash_against_all_pairs(spark_llm, odd, none):
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for i in range(60):
        words = list(base if i % 3 else base[:60] + [f"x{k}" for k in range(60)])
        for k in rng.integers(0, 120, i % 6):
            words[k] = f"n{i}_{k}"
        texts.append(" ".join(words).title() if i % 2 else " ".join(words))
    texts += ["", "a b c", "A B  c", "a b c d", None]
    rows = list(enumerate(texts))
    df = spark_llm.createDataFrame(rows, "doc_id long, text string")

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {i: shingles(t) for i, t in rows}
    want = brute_groups([i for i, _ in rows], lambda a, b: sets[a] and sets[b] and
                        100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    for r in minhash.near_duplicates(df).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (
            len(sets[r.doc_id]), want[r.doc_id], r.doc_id == want[r.doc_id])
    left = minhash.one_of_each_group(df).collect()
    assert {r.doc_id for r in left} == {i for i in want if want[i] == i}
    assert len(minhash.near_duplicates(odd).collect()) == odd.count()
    one = minhash.one_of_each_group(odd)
    assert one.columns == odd.columns
    assert one.where("text = 'the same text here again and again'").count() == 1
    assert minhash.near_duplicates(none).count() == 0


def test_one_row_of_a_group_stays_whatever_its_ids_are(spark_llm):
    def near(name):
        words = [f"{name}{k}" for k in range(200)]
        return " ".join(words), " ".join([*words[:100], "other", *words[101:]])

    rows = [*((1, t) for t in near("a")), *((None, t) for t in near("b")),
            *zip((3, 4), near("c"), strict=True), (1, " ".join(f"d{k}" for k in range(200)))]
    df = spark_llm.createDataFrame(rows, "doc_id long, text string")
    left = minhash.one_of_each_group(df).collect()
    assert sorted((r.doc_id or 0, r.text[0]) for r in left) == [(0, "b"), (1, "a"), (1, "d"), (3, "c")]


def test_large_buckets_are_cut(spark_llm, monkeypatch):
    """Chunks find the same groups as whole buckets."""
    monkeypatch.setattr(minhash, "CHUNK", 5)
    base = [f"w{k}" for k in range(200)]
    rows = [(i, " ".join([*base[:i], f"n{i}", *base[i + 1:]])) for i in range(40)]
    df = spark_llm.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in minhash.near_duplicates(df).collect()} == {0}


def test_embeddings_against_all_pairs(spark_llm):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 24))
    vectors = [(centres[i % 12] + rng.standard_normal(24) * (.02 + .03 * (i % 9))).tolist() for i in range(150)]
    vectors += [vectors[3], None, [], [0.0] * 24, [float("nan")] * 24, [1.0, None], [1.0, 2.0],
                [2.0, 4.0], [float("inf")] * 24, [1e200, 0.0], [5.0, 0.0]]
    rows = [(i, v, "x") for i, v in enumerate(vectors)]
    df = spark_llm.createDataFrame(rows, "vec_id long, embedding array<double>, n_links string")

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v) / max(map(abs, v))
        return v / np.linalg.norm(v)

    units = [unit(v) for v in vectors]
    near = lambda a, b: (units[a] is not None and units[b] is not None and len(units[a]) == len(units[b])
                         and units[a] @ units[b] >= .9)
    ids = range(len(rows))
    want = brute_groups(ids, near)
    for r in embed_dedup.near_duplicates(df).collect():
        assert r.n_links == sum(near(r.vec_id, b) for b in ids if b != r.vec_id)
        assert (r.component_id, r.kept) == (want[r.vec_id], want[r.vec_id] == r.vec_id)
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_hot_buckets_are_cut_and_ids_may_repeat(spark_llm, monkeypatch):
    monkeypatch.setattr(embed_dedup, "HOT_ROWS", 20)
    monkeypatch.setattr(embed_dedup, "CHUNK", 16)
    rng = np.random.default_rng(8)
    base = rng.standard_normal((3, 16))
    vectors = [*(base[0] + rng.standard_normal((90, 16)) * .12), *(base[1] + rng.standard_normal((20, 16)) * .3),
               *rng.standard_normal((30, 16))]
    ids = [None if i == 4 else 50 if i == 51 else i for i in range(len(vectors))]
    df = spark_llm.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)],
                                   "vec_id long, embedding array<double>")
    units = np.array([v / np.linalg.norm(v) for v in vectors])
    near = units @ units.T >= .9
    np.fill_diagonal(near, False)
    group, todo = {}, set(range(len(ids)))
    while todo:
        found, edge = set(), {min(todo)}
        while edge:
            found |= edge
            edge = {j for i in edge for j in np.flatnonzero(near[i]).tolist()} - found
        todo -= found
        known = [ids[i] for i in found if ids[i] is not None]
        group |= {i: min(known, default=None) for i in found}
    want = sorted(((ids[i], int(near[i].sum()), group[i]) for i in range(len(ids))), key=repr)
    rows = embed_dedup.near_duplicates(df).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=repr) == want


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    units = rng.standard_normal((300, 64))
    units[150:] = units[:150] + rng.standard_normal((150, 64)) * .4
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    turned, signs, factors = embed_dedup.encode(units, 12, 40)
    value, spread = embed_dedup.estimates(turned, signs, factors, turned)
    error = value - units @ units.T
    assert abs(error.mean()) < .01
    assert (np.abs(error) <= embed_dedup.SURE * spread[:, None]).mean() > .999


def test_shards(spark_llm, odd, none):
    rows = [(i, f"text {i % 40}" if i % 3 else "copy") for i in range(500)] + [(None, None), (7, "copy")]
    df = spark_llm.createDataFrame(rows, "doc_id long, text string")
    found = sharding.shard_rows(df).collect()
    assert len(found) == len(rows)
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r.slot)
    sizes = [len(v) for v in by_shard.values()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    text = dict(rows)
    assert all(r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode())
               for r in found if r.doc_id != 7)
    copies = {r.shard for r in found if r.text_crc32 == zlib.crc32(b"copy")}
    assert len(copies) < 16  # a third of the rows: more than a shard, not all shards
    assert len(sharding.shard_rows(odd).collect()) == odd.count()
    assert sharding.shard_rows(none).count() == 0


def test_toxicity_training_holds_numbers_for_words():
    texts = [" ".join(f"word{(7 * i + k) % 50}" for k in range(4000)) for i in range(100)]
    tracemalloc.start()
    assert toxicity.train(texts, [i % 2 for i in range(100)], steps=0) is not None
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 400,000 words: as objects they alone take 60 bytes each
    assert peak < 32_000_000

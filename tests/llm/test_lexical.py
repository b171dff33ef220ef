"""Ranked search against scoring every document."""

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tubetrace.llm import lexical


def brute(docs, items, k):
    held = [(i, Counter(lexical.terms_of((t or "").encode()))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        wanted = Counter(lexical.terms_of((text or "").encode()))
        scores = []
        for i, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            score = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, r in wanted.items() if c[t])
            if score > 0:
                scores.append((-score, i is None, i if i is not None else 0))
        out += [(item, r, None if null else i, -s)
                for r, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def test_terms():
    assert lexical.terms_of("Ab-C9 ÉÉ_x\x7f日本, É".encode()) == [
        b"ab", b"c9", "ÉÉ".encode(), b"x", "日本".encode(), "É".encode()]


WORDS = st.sampled_from("a b c d e f g hh ii jj".split())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(WORDS, min_size=1, max_size=8), min_size=1, max_size=40),
       st.lists(WORDS, min_size=1, max_size=6), st.integers(1, 5), st.integers(1, 9))
def test_block_search_is_exact(docs, item, k, opened):
    # impacts are small, so equal scores abound
    vocabulary = {t: n for n, t in enumerate(sorted({w for d in docs for w in d} | set(item)))}
    counts = [Counter(d) for d in docs]
    owner = np.array([i for i, c in enumerate(counts) for _ in c])
    term = np.array([vocabulary[t] for c in counts for t in c])
    impact = np.array([n for c in counts for n in c.values()], np.int64)
    keys = [(i * 7) % len(docs) if len(docs) % 7 else i for i in range(len(docs))]
    block = lexical.Block(keys, owner, term, impact)
    wanted = Counter(item)
    held = lexical.Best()
    lexical.OPEN, before = opened * len(wanted), lexical.OPEN
    block.best(np.array([vocabulary[t] for t in wanted]), np.array(list(wanted.values())), k, held)
    lexical.OPEN = before
    scores = sorted((-sum(r * c[t] for t, r in wanted.items()), False, i)
                    for i, c in zip(keys, counts, strict=True) if any(c[t] for t in wanted))
    assert held.rows == scores[:k]


@pytest.mark.parametrize(("postings", "round_terms"), [(400_000, 1_000_000), (50, 20)])
def test_search(spark_llm, monkeypatch, postings, round_terms):
    monkeypatch.setattr(lexical, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(lexical, "ROUND_TERMS", round_terms)
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(60)]
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 40)))) for i in range(200)]
    docs += [(200 + i, docs[3][1]) for i in range(60)]  # ties
    docs += [(None, docs[3][1]), (5, docs[5][1]), (900, None), (901, ""), (902, "-- !"),
             (903, "w1 " * 20_000)]
    items = [(i, " ".join(rng.choice(words, 6))) for i in range(8)]
    items += [(8, docs[3][1]), (9, None), (10, "unknown terms"), (None, "w1 w1 W1"), (0, "w2")]
    tables = [spark_llm.createDataFrame(docs, "doc_id long, text string").repartition(5),
              spark_llm.createDataFrame(items, "item_id long, text string")]
    for k in (1, 20):
        got = [tuple(r) for r in lexical.search(*tables, k=k).collect()]
        assert sorted(got, key=repr) == brute(docs, items, k)


def test_odd_and_empty_tables(spark_llm, odd, none):
    items = spark_llm.createDataFrame([(1, "the same text"), (2, "one word")],
                                      "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = [tuple(r) for r in lexical.search(odd, items).collect()]
    assert sorted(got, key=repr) == brute(rows, [(1, "the same text"), (2, "one word")], 20)
    assert lexical.search(none, items).count() == 0
    assert lexical.search(odd, items.limit(0)).count() == 0

"""Exact duplicates against a plain grouping."""

from collections import defaultdict
from hashlib import sha256

import pytest

from tubetrace.llm import exact_dedup
from tubetrace.llm.common import WORD_SPACE


def brute(rows):
    """Sorted (doc_id, keep_id, group_size, sha); and who stays, per group."""
    groups = defaultdict(list)
    for r in rows:
        groups[(r.text or "").encode().translate(None, WORD_SPACE)].append(r)
    out = []
    for content, members in groups.items():
        best = min(members, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        out += [(r.doc_id, best.doc_id, len(members), sha256(content).hexdigest()) for r in members]
    return sorted(out, key=repr), len(groups)


def check(docs, **options):
    want, n_groups = brute(docs.collect())
    rows = exact_dedup.deduplicate(docs, **options).collect()
    got = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows]
    assert sorted(got, key=repr) == want
    assert sum(r.kept for r in rows) == n_groups
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_odd_rows(odd, none):
    check(odd)
    left = exact_dedup.distinct_documents(odd)
    assert left.columns == odd.columns
    assert exact_dedup.deduplicate(none).count() == 0


@pytest.mark.parametrize("digest_bytes", [0, 1, 32])
def test_hot_groups_in_many_tasks_and_full_tables(spark_llm, monkeypatch, digest_bytes):
    # one text holds half of the rows; tables are put out after every few contents, salts
    # stand for two tasks, and short digests collide
    monkeypatch.setattr(exact_dedup, "LOCAL_BYTES", 600)
    monkeypatch.setattr(exact_dedup, "FAN", 2)
    if digest_bytes:  # bits are set by chance
        monkeypatch.setattr(exact_dedup, "SLOT_BITS", 6)
    texts = ["hot  text", "hottext", "ho ttext  \n "] * 100 + [f"t {k % 90}" for k in range(300)]
    docs = spark_llm.createDataFrame([(k * 7 % 600, t) for k, t in enumerate(texts)],
                                     "doc_id long, text string").repartition(12)
    check(docs, digest_bytes=digest_bytes)


def test_only_the_named_white_space_is_deleted(spark_llm):
    docs = spark_llm.createDataFrame(
        [(1, "a b"), (2, "a b"), (3, "ab"), (4, "a\x1cb"), (5, "a\tb\x0b")],
        "doc_id long, text string")
    kept = {r.doc_id: r.keep_id for r in exact_dedup.deduplicate(docs).collect()}
    assert kept == {1: 5, 2: 2, 3: 5, 4: 4, 5: 5}

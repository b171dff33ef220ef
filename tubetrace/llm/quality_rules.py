"""Line-first cleaning with quality rules (operator 7).

Every line is judged first and for itself; the lines that fail are removed, and a document
goes if too little of its text is left. A line fails one of these rules:

* symbols: more than 3 characters of ``#*$%&|<>`` for 10 words,
* shouting: at least 20 letters A-Z, and more than twice as many as letters a-z,
* navigation: at least 3 separators (``|``, ``>``, ``<``), and one for 4 words or more,
* repetition: at least 10 words, fewer than 3 in 10 of them distinct,
* boilerplate: a line of at most 30 words that holds one of ``BOILERPLATE``, in any case,
* punctuation: at least 40 words and neither a full stop, question mark, exclamation mark,
  colon nor semicolon of any script in ``STOPS`` and ``OTHER_STOPS`` among its characters.

The document is kept if its base rules hold (at least 20 words, at most 30 % of them in
repeated windows of 8) and the remaining lines hold at least half of the characters of its
words. Null texts are empty: no words, rejected. Lines without a word neither fail nor
count. Texts of any length take time and memory in proportion. Each row is judged alone, so
repeated rows give equal rows and an empty table an empty one. Of further columns only
``carry`` is kept.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import LOWER, TO_LOWER, UPPER, fields_of, hidden, sent, shown, texts, words

# fixed values
SYMBOLS, SEPARATORS, STOPS = b"#*$%&|<>", b"|<>", b".!?:;"
# fixed values: marks of other scripts that end a sentence or a part of one
OTHER_STOPS = "।॥؟۔؛።፧፤。！？：；．｡…։՜՞჻။៕༎"
FOUND_OTHER_STOP = re.compile("|".join(OTHER_STOPS).encode()).search
BOILERPLATE = [
    "all rights reserved", "accept cookies", "cookie policy", "privacy policy",
    "terms of service", "terms of use", "click here", "sign up for our newsletter",
    "subscribe to our newsletter", "share this page", "skip to content", "back to top",
    "javascript is disabled", "enable javascript", "lorem ipsum",
]
FOUND_BOILERPLATE = re.compile("|".join(BOILERPLATE).encode()).search
WINDOW = 8
SPACES = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))


def count_of(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def repeated_words(found: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` words (a power of two) that occur twice or more.

    Windows get exact numbers by doubling: equal pairs of numbers of half the length.
    """
    n = len(found)
    if n <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in found], np.int64)
    if n - len(number) < window:  # a repeated window needs as many repeated words
        return 0
    step = 1
    while step < window:
        left, right = ids[:-step], ids[step:]
        ids = np.unique(left * n + right, return_inverse=True)[1].reshape(-1)
        step *= 2
    again = np.bincount(ids)[ids] > 1
    if not again.any():
        return 0
    cover = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover) > 0).sum())


def line_fails(line: bytes, found: list[bytes]) -> bool:
    """Whether a line with the words ``found`` (at least one) fails a rule."""
    n = len(found)
    bare = line.translate(None, SYMBOLS)
    if len(bare) != len(line):
        if 10 * (len(line) - len(bare)) > 3 * n:
            return True
        separators = count_of(line, SEPARATORS)
        if separators >= 3 and 4 * separators >= n:
            return True
    upper = count_of(line, UPPER)
    if upper >= 20 and upper > 2 * count_of(line, LOWER):
        return True
    if n >= 10 and 10 * len(set(found)) < 3 * n:
        return True
    if n <= 30 and FOUND_BOILERPLATE(line.translate(TO_LOWER)):
        return True
    return n >= 40 and not count_of(line, STOPS) and not FOUND_OTHER_STOP(line)


def judge(text: bytes) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    n_lines, n_failed_lines, kept_chars, cleaned text)"""
    found = words(text)
    n = len(found)
    chars = len(text.translate(None, SPACES + CONTINUATION))
    repeat = repeated_words(found)
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    held = n_lines = failed = 0
    clean = []
    for line in lines:
        in_line = line.split()
        if not in_line:
            clean.append(line)
            continue
        n_lines += 1
        seen.add(line)
        if line_fails(line, in_line):
            failed += 1
        else:
            clean.append(line)
            held += len(line.translate(None, SPACES + CONTINUATION))
    base_failed = n < 20 or 100 * repeat > 30 * n
    kept = not base_failed and 2 * held >= chars
    return (n, chars, count_of(text, SYMBOLS), n_lines - len(seen), repeat, base_failed, kept,
            n_lines, failed, held, b"\n".join(clean))


FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, n_lines long, "
          "n_failed_lines long, kept_chars long")


def judge_documents(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",),
                    with_text: bool = False) -> DataFrame:
    """Adds ``FIELDS`` to the carried columns; with ``with_text`` also ``cleaned``, the text
    without the lines that failed."""
    schema = docs.select(*carry).schema
    for field in fields_of(FIELDS + ", cleaned string" * with_text):
        schema = schema.add(field)
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 3 + [pa.string()] * with_text
    n = len(carry)
    rows_sent, place = sent(docs, carry, text)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows = list(zip(*map(judge, texts(batch.column(place))), strict=True))
                made = [pa.array([v.decode() for v in c] if k == pa.string() else c, k)
                        for c, k in zip(rows, kinds, strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in range(n)] + made, schema.names)

    return rows_sent.mapInArrow(run, schema)


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, all columns as they were."""
    rows = hidden(docs)
    return shown(judge_documents(rows, f"in_{text}", tuple(rows.columns)).where("kept"), docs)

"""Perspective rotation against a plain rendering."""

from collections import defaultdict

from tubetrace.llm import chat

ROWS = [(1, 0, "ann", "Hi."), (1, 1, "bob", "Hello"), (1, 2, "ann", None), (1, 1, "bob", "Hello"),
        (1, None, "cat", "late"), (1, None, "bob", "later"), (2, 5, None, "alone"), (2, 5, "", "too"),
        (None, 0, "ann", "no id"), (None, 0, "bob", "no id")]


def render(turns, me):
    text, spans = "", []
    for role, body in turns:
        text += chat.BEGIN + ("assistant" if role == me else f"user name={role}") + "\n"
        if role == me:
            spans.append((len(text), len(text) + len(body) + len(chat.END)))
        text += body + chat.END + "\n"
    return text, spans


def test_rotation(spark_llm):
    rows = ROWS + [(3, t, f"p{t % 3}", f"turn {t}") for t in range(100)]
    df = spark_llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = defaultdict(list)
    for r in chat.rotate(df).collect():
        parts[r.conv_id, r.perspective].append(r)
    whole = {}
    for key, found in parts.items():
        text, spans = "", []
        for r in sorted(found, key=lambda r: r.part):
            spans += [(len(text) + s, len(text) + e) for s, e in zip(r.mask_start, r.mask_end, strict=True)]
            text += r.rendered
            assert r.n_turns <= chat.PART_TURNS and r.n_trained == len(r.mask_start)
        whole[key] = (text, spans)
    for me in ("p0", "p1", "p2"):
        assert whole[3, me] == render([(f"p{t % 3}", f"turn {t}") for t in range(100)], me)
    assert whole[2, "unknown"] == render([("unknown", "alone"), ("unknown", "too")], "unknown")
    assert whole[None, "ann"] == render([("ann", "no id")], "ann")
    assert {k[1] for k in whole if k[0] == 1} == {"ann", "bob", "cat"}
    text, spans = whole[1, "bob"]
    assert text.startswith(
        render([("ann", "Hi."), ("bob", "Hello"), ("bob", "Hello"), ("ann", "")], "bob")[0])
    assert [text[s:e] for s, e in spans] == ["Hello" + chat.END] * 2 + ["later" + chat.END]


def whole_dialogues(spark, rows, extra=""):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string" + extra)
    parts = defaultdict(list)
    for r in chat.rotate(df).collect():
        parts[r.conv_id, r.perspective].append((r.part, r.rendered))
    return {key: "".join(t for _, t in sorted(found)) for key, found in parts.items()}


def test_every_turn_is_kept(spark_llm, monkeypatch):
    monkeypatch.setattr(chat, "PIECE", 7)
    rows = [(1, None, "ann", "yes"), (1, None, "ann", "yes"), (2, 0, "ann", None), (2, 0, "ann", ""),
            (2, 0, None, "x"), (2, 0, "", "x"), *[(3, 4, "bob", "again")] * 100, (3, 5, "cat", "end"),
            (None, 0, "ann", "alone"), (None, 0, "ann", "alone")]
    whole = whole_dialogues(spark_llm, rows)
    assert whole[1, "ann"] == render([("ann", "yes")] * 2, "ann")[0]
    assert whole[2, "ann"] == render([("ann", "")] * 2 + [("unknown", "x")] * 2, "ann")[0]
    assert whole[3, "cat"] == render([("bob", "again")] * 100 + [("cat", "end")], "cat")[0]
    # two dialogues of one turn, put together here
    assert whole[None, "ann"] == render([("ann", "alone")], "ann")[0] * 2


def test_long_texts_and_clashing_columns(spark_llm):
    long = "word after word\n" * 50_000
    rows = [(1, 0, "ann", long, 1, "a", 5), (1, 1, "bob\nby", "b", 2, "b", 6)]
    whole = whole_dialogues(spark_llm, rows, ", position int, dialogue string, times int")
    assert whole[1, "ann"] == render([("ann", long), ("bob by", "b")], "ann")[0]


def test_empty(spark_llm):
    df = spark_llm.createDataFrame([], "conv_id long, turn long, role string, text string, part int")
    assert chat.rotate(df).count() == 0

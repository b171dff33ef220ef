"""The pipeline against its parts, stage by stage."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tubetrace.llm import packing, quality_rules, toxicity

NET = toxicity.train(*(lambda n: (["fine words here"] * n + ["vile words here"] * n, [0] * n + [1] * n))(20), steps=60)


def test_near_copies_from_eight_tenths_on_are_linked(spark_llm, tmp_path):
    words = [f"w{k}" for k in range(200)]
    near = [f"n{k}" if k in (20, 60, 100, 140) else w for k, w in enumerate(words)]  # 176 of 216
    docs = spark_llm.createDataFrame(
        [(i, " ".join(w)) for i, w in enumerate((words, near))], "doc_id long, text string")
    left = corpus_pipeline.distinct(spark_llm, docs, str(tmp_path)).collect()
    assert [r.doc_id for r in left] == [0]


def test_stages(spark_llm, odd, tmp_path, monkeypatch):
    prose = [" ".join(f"w{i}_{k}" for k in range(60)) + "." for i in range(4)]
    rows = [(i, t) for i, t in enumerate([*prose, prose[0], prose[1] + " vile", "$$$ " * 40, None, ""])]
    docs = spark_llm.createDataFrame(rows, "doc_id long, text string")
    spark_llm.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(toxicity, "train", lambda *a, **k: NET)
    assert len(corpus_pipeline.STAGES) == 4
    kept = [0, 1, 2, 3, 4, 5]
    for (_, stage), want in zip(corpus_pipeline.STAGES, [kept, [0, 1, 2, 3, 4], [0, 1, 2, 3]], strict=False):
        docs = stage(spark_llm, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text"]
        assert sorted(r.doc_id for r in docs.collect()) == want
    found = corpus_pipeline.run(spark_llm, str(tmp_path)).collect()
    assert {r.doc_id for r in found} == {0, 1, 2, 3}


def plan(rows):
    return rows._jdf.queryExecution().analyzed().toString()


def test_stages_send_a_text_to_python_once(spark_llm):
    docs = spark_llm.createDataFrame([(1, "fine words here")], "doc_id long, text string")
    learn = docs.select("doc_id", F.lit(0).alias("toxic"))
    assert "__text" not in plan(quality_rules.kept_documents(docs))
    assert "__text" not in plan(toxicity.clean_documents(docs, learn, net=NET))


def test_stages_hold_few_words_in_a_worker_that_serves_them_all(spark_llm, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    text = " ".join(f"word{k} w{chr(97 + k % 26)}{chr(97 + k // 26)}." for k in range(300))
    encode, whole = packing.WordIds(path, 20), packing.WordIds(path)
    parts = [" ".join(text.split()[at:at + 10]) for at in range(0, 600, 10)]
    assert [encode([t]) for t in parts] == [whole([t]) for t in parts]
    assert max(len(encode.known) + len(encode.old), len(encode.words) + len(encode.words.old)) <= 80
    asked = []
    monkeypatch.setattr(packing, "pieces", lambda *a, **k: asked.append(a[-1]) or a[0])
    monkeypatch.setattr(packing, "pack", lambda rows, *a: rows)
    docs = spark_llm.createDataFrame([(1, text)], "doc_id long, text string")
    corpus_pipeline.packed(spark_llm, docs, "")
    assert asked == [corpus_pipeline.REMEMBERED] and asked[0] < packing.REMEMBERED

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docket.session import staged
from tests.llm.test_phrases import brute as repeats
from tests.llm.test_tokens import PACK_TOKENIZER, direct


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghk") for _ in range(rng.randint(2, 6)))
    say = lambda n: [word() for _ in range(n)]
    item, passage, base = say(20), say(60), say(120)
    docs, labels = [], []
    for i in range(200):
        ws = say(rng.randint(20, 60))
        if i % 4 == 0:
            ws[5] = "scumbag"
        labels.append((i, int(i % 4 == 0)))
        if i in (41, 43):
            ws = ws + item
        if i in (51, 53, 55):
            ws = ws + passage
        if i in (61, 63, 65):
            ws = base[:-1] + [word()]
        docs.append((i, " ".join(ws)))
    docs += [(300, "sc\u0075mb4g and more words here"), (301, None), (302, ""), (None, "a row without id"), (303, docs[1][1])]
    folder = str(tmp_path_factory.mktemp("data"))
    rows = [(i, t, "en", "src", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, item


def test_each_stage_takes_effect(spark, small):
    folder, rows, item = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    key = lambda x: (x[0] is None, x[0] or 0)
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if k < 4:
            assert out.columns == columns
        out.write.parquet(f"{folder}/out-{name}")
        docs = spark.read.parquet(f"{folder}/out-{name}")
        seen[name] = docs.collect()
    text = {name: sorted(((r["doc_id"], r["text"]) for r in seen[name]), key=key) for name in list(seen)[:4]}
    clean = [(i, t) for i, t in rows if "scumbag" not in (t or "") and i != 300]
    assert text["toxicity"] == sorted(clean, key=key)
    assert text["near_duplicates"] == [x for x in text["toxicity"] if x[0] not in (63, 65, 303)]
    cut = {(i, gone > 0): kept for i, n, gone, kept in repeats(text["near_duplicates"], 13)}
    want = [(i, cut.get((i, True), t)) for i, t in text["near_duplicates"]]
    assert text["repeated_phrases"] == want and [i for i, g in cut if g] == [43, 53, 55]
    assert all(r["n_chars"] == len(r["text"] or "") for r in seen["repeated_phrases"])
    assert text["decontamination"] == [x for x in want if x[0] != 41]
    ids = {}
    for r in sorted(seen["packing"], key=lambda r: (r["sequence_id"], r["offset"])):
        ids.setdefault(r["doc_id"], []).extend(np.frombuffer(bytes(r["ids"]), "<u4").tolist())
    assert ids == {i: direct(PACK_TOKENIZER, t, 1) for i, t in text["decontamination"]}


def test_run_gives_the_pieces_of_the_last_stage(spark, small):
    folder, *_ = small
    total = corpus_pipeline.run(spark, folder).groupBy().sum("length").first()[0]
    assert total == sum(r["length"] for r in spark.read.parquet(f"{folder}/out-packing").collect())


CLASHES = ["score", "predicted", "n_words", "n_removed", "__block", "__rest", "class_id", "item_id", "h", "ids", "n", "a.b"]


def test_other_columns_may_have_any_name(spark, small):
    """Columns named like an operator's own are handed on as they are, stage by stage."""
    folder, _, _ = small
    plain = spark.read.parquet(f"{folder}/documents.parquet")
    extra = [F.concat(F.lit(c), F.coalesce(F.col("doc_id"), F.lit(-1))).alias(c) for c in CLASHES]
    docs = plain.select("*", *extra)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name == "packing":
            assert out.count() > 0
            break
        out = staged(out, "stage")
        assert out.columns == docs.columns
        expected = {(r["doc_id"], r["text"]) for r in staged(stage(spark, plain, folder), "plain").collect()}
        rows = out.collect()
        assert {(r["doc_id"], r["text"]) for r in rows} == expected
        for r in rows:
            assert all(r[c] == f"{c}{-1 if r['doc_id'] is None else r['doc_id']}" for c in CLASHES)
        docs, plain = out, out.select("doc_id", "text", "lang", "source", "n_chars")


def test_only_id_and_text(spark, small):
    folder, _, _ = small
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    for name, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, folder).columns == ["doc_id", "text"]

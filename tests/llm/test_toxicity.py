import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from docket.llm import toxicity as tox
from docket.llm.words import text_bytes

CLEAN = "the cat sat on the mat and the sun was out so we all went to the park with an idiot and a moron or a clown of trash".split()


def model():
    text = " ".join(CLEAN * 50)
    code = tox._codes()[np.frombuffer(text.encode(), np.uint8)]
    code = np.concatenate([[0], code, [0]])
    counts = np.bincount(code[:-2] * 729 + code[1:-1] * 27 + code[2:], minlength=27**3).reshape(27, 27, 27)
    return tox.letter_model(counts)


def test_restores_swaps_spacing_and_repetition():
    m = model()
    for written in ("1d10t", "i.d.i.o.t", "idiooot", "1-d-!-0-t", "IDI0T", "idiot"):
        assert tox.restore(written, m) == "idiot", written
    assert tox.restore("m0r0n", m) == "moron" and tox.restore("tr@$h", m) == "trash" and tox.restore("", m) == ""
    assert len(tox.restore("a1" * 20_000, m)) > 0


def test_viterbi_finds_the_best_of_all_readings():
    m = model()
    word = "tr4s1"

    def price(text, cost):
        s, total = [0, 0, *(ord(c) - 96 for c in text), 0], cost
        return total + sum(m[a][b][c] for a, b, c in zip(s, s[1:], s[2:]))

    readings = [("tr", 0.0)]
    for ch in word[2:]:
        options = [(ch, 0.0)] if ch.isalpha() else [(x, tox.SWAP) for x in tox.STANDS_FOR[ch]] + [("", tox.DROP_DIGIT)]
        readings = [(t + o, c + p) for t, c in readings for o, p in options]
    assert tox.restore(word, m) == max(readings, key=lambda r: price(*r))[0]


def test_words_as_written_and_restored():
    rows, hashes = tox.Restorer(model()).words(*text_bytes(pa.array(["An 1d10t, a i d i o t", None, "", "Idiot!"])))
    _, wanted = tox.Restorer(model()).words(*text_bytes(pa.array(["idiot"])))
    assert [int((rows[hashes == wanted[0]] == r).sum()) for r in range(4)] == [2, 0, 0, 1]


def frame(spark, n=600):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        ws = [rng.choice(CLEAN[:20]) for _ in range(rng.randint(3, 40))]
        bad = i % 5 == 0
        if bad:
            ws.insert(rng.randrange(len(ws)), rng.choice(["moron", "m0ron", "M.O.R.O.N", "moooron", "m o r o n"]))
        rows.append((i, " ".join(ws), "x", 3))
        labels.append((i, int(bad)))
    rows += [(n, None, "x", 3), (n + 1, "", "x", 3), (None, "a moron", "x", 3), (n + 2, "moron " * 30_000, "x", 3)]
    labels += [(n, None), (n + 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, toxic int"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy_and_edge_rows(spark):
    docs, labels = frame(spark)
    fitted = tox.fit(docs, labels, tox.in_fold(F.col("doc_id"), 4, 2))
    out = tox.score(docs, fitted)
    assert out.columns == ["doc_id", "text", "toxic", "score", "predicted"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == 604
    assert all(got[i]["predicted"] == int(i % 5 == 0) for i in range(600))
    assert got[600]["score"] == got[601]["score"] < 0.3 and got[None]["predicted"] == got[602]["predicted"] == 1


def test_no_labels_and_empty_tables(spark):
    docs, labels = frame(spark, 10)
    held = tox.in_fold(F.col("doc_id"), 4, 2)
    assert {r["predicted"] for r in tox.score(docs, tox.fit(docs, labels.limit(0), held)).collect()} == {0}
    assert tox.score(docs.limit(0), tox.fit(docs.limit(0), labels, held)).collect() == []


def test_query_on_held_out_rows(spark, folder):
    from docket.llm.queries import op3_toxicity, table

    got = {r["doc_id"]: r for r in op3_toxicity(spark, folder).collect()}
    docs = {r["doc_id"]: r for r in table(spark, folder, "documents").collect()}
    assert set(got) == set(docs)
    labels = [r for r in table(spark, folder, "labels").collect() if docs[r["doc_id"]]["lang"] == "en" and got[r["doc_id"]]["held_out"]]
    wrong = sum(r["toxic"] != got[r["doc_id"]]["predicted"] for r in labels)
    assert len(labels) > 5 and wrong <= 1


def test_every_form_of_disguise_is_read():
    m = model()
    forms = {
        "idiot": ["1d107", "1d10t", "!diot", "|diot", "(!d!0+)", "iidiot", "idiiot", "id iot", "idi ot,", "i di ot", "1d iot"],
        "moron": ["mor on", "m0r on", "morron", "mo ro n"],
        "clown": ["(lown", "<lown", "c£own", "cl own"],
        "trash": ["+r4$h", "+r@5h", "tra sh"],
        "the": ["th€", "+h3", "7h€"],
    }
    for word, written in forms.items():
        _, wanted = tox.Restorer(m).words(*text_bytes(pa.array([word])))
        for text in written:
            rows, hashes = tox.Restorer(m).words(*text_bytes(pa.array(["x", f"zz zzzzz {text} zzzzz", None])))
            assert rows[hashes == wanted[0]].tolist() == [1], text


def test_fragments_are_not_joined_over_rows():
    rows, hashes = tox.Restorer(model()).words(*text_bytes(pa.array(["zzzzz id", "iot zzzzz"])))
    _, wanted = tox.Restorer(model()).words(*text_bytes(pa.array(["idiot"])))
    assert wanted[0] not in hashes


def test_each_of_several_insults_that_come_together_decides_alone(spark):
    rng = random.Random(6)
    bad = ["moron", "clown", "idiot", "trash"]
    rows, labels = [], []
    for i in range(800):
        ws = [rng.choice(CLEAN[:20]) for _ in range(20)] + (rng.sample(bad, 3) if i % 6 == 0 else [])
        rows.append((i, " ".join(ws)))
        labels.append((i, int(i % 6 == 0)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    fitted = tox.fit(docs, labels, F.lit(False))
    texts = spark.createDataFrame([(w, f"the cat and the {w} went to the park") for w in [*bad, "sun"]], "w string, text string")
    assert {r["w"]: r["predicted"] for r in tox.score(texts, fitted).collect()} == {**dict.fromkeys(bad, 1), "sun": 0}


def test_beginnings_of_words_one_and_several():
    rows, hashes = tox.Restorer(model()).words(*text_bytes(pa.array(["zabcdefgh x", "Zabcdefgh zabcdefij", "zabcdefgh zabcdefgh", "zabcdef"])))
    begin = tox.span_hashes(np.frombuffer(b"zabcdef", np.uint8), np.array([0]), np.array([7]))
    one, two = tox.mix(begin, tox.PREFIX)[0], tox.mix(begin, tox.PREFIX + 1)[0]
    assert sorted(rows[hashes == one].tolist()) == [0, 1, 2] and rows[hashes == two].tolist() == [1]


def test_recall_and_false_alarms_in_each_language(spark, folder):
    import os

    import pytest

    from docket.llm.queries import op3_toxicity, table

    larger = os.path.join(os.path.dirname(folder), "sf0.1")
    if not os.path.isdir(larger):
        pytest.skip("needs the larger tables")
    labels = table(spark, larger, "labels").where("toxic is not null").select("doc_id", "toxic")
    rows = op3_toxicity(spark, larger).where("held_out").join(labels, "doc_id").join(table(spark, larger, "documents").select("doc_id", "lang"), "doc_id").collect()
    langs = {r["lang"] for r in rows}
    assert len(langs) == 4
    for lang in langs:
        toxic = [r["predicted"] for r in rows if r["lang"] == lang and r["toxic"]]
        assert sum(toxic) >= 0.8 * len(toxic), lang
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert sum(clean) <= 0.01 * len(clean)

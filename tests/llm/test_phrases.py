import random
import re

from docket.llm.phrases import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    smallest = {}
    for i, ws in words:
        if i is not None:
            for k in range(len(ws) - size + 1):
                w = tuple(ws[k : k + size])
                smallest[w] = min(i, smallest.get(w, i))
    out = []
    for i, ws in words:
        gone = [False] * len(ws)
        for k in range(len(ws) - size + 1):
            if i is not None and smallest[tuple(ws[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        out.append((i, len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone) if not g)))
    return out


def rows():
    rng = random.Random(3)
    word = lambda: rng.choice("a b c d e f g hé ï".split()) + rng.choice(["", "x", "y", "zz"])
    passages = [[word() for _ in range(rng.randint(8, 40))] for _ in range(12)]
    out = []
    for i in range(150):
        ws = []
        for _ in range(rng.randint(0, 4)):
            ws += [word() for _ in range(rng.randint(0, 30))]
            p = rng.choice(passages)
            a = rng.randint(0, 5)
            ws += p[a : len(p) - rng.randint(0, 4)]
        out.append((i, rng.choice([" ", "\n", "  \t"]).join(ws)))
    out += [(i, out[i][1]) for i in (5, 9, 9)] + [(400 + i, out[7][1]) for i in range(20)]
    out += [(None, out[3][1]), (900, None), (901, ""), (902, "\x0b \n"), (903, "one two")]
    out += [(5, "q " * 5000), (950, "q " * 3000 + out[8][1]), (951, "a b c " * 20), (952, "a b c " * 20)]
    return out


def test_equals_brute_force(spark):
    data = rows()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in data], "doc_id long, text string, anchor string, n_words int")
    got = remove_repeats(docs)
    assert got.columns == ["doc_id", "text", "anchor", "n_words", "n_removed"]
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got.collect()), key=key) == sorted(brute(data, 13), key=key)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []

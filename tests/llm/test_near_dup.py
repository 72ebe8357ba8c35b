import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from docket.llm import near_dup
from docket.llm.components import components


def make():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    line = [word() for _ in range(12)]
    rows = []
    for g in range(25):
        base = [word() for _ in range(rng.randint(60, 200))]
        for c in range(rng.randint(1, 6)):
            ws = list(base)
            for _ in range(c % 3):
                ws[rng.randrange(len(ws))] = word()
            rows.append(" ".join(line + ws if g % 4 == 0 else ws))
    rows += [rows[3]] * 30 + ["", None, "  ", "tiny text", "tiny text", "one", "w " * 8000, "w " * 8001]
    return list(enumerate(rows))


def brute(rows, table):
    sets = {}
    for i, t in rows:
        row, value, count = near_dup.shingles(pa.array([t], pa.string()))
        sets[i] = {v: w for v, w in zip(value.tolist(), near_dup.weight(table, value, count).tolist())}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    close = 0
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                keys = sets[i].keys() | sets[j].keys()
                s = sum(min(sets[i].get(k, 0), sets[j].get(k, 0)) for k in keys) / sum(max(sets[i].get(k, 0), sets[j].get(k, 0)) for k in keys)
                close += 0.8 <= s < 1
                if s >= 0.8:
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    assert close > 20
    return {i: root(i) for i in sets}


def test_classes_equal_brute_force(spark):
    rows = make()
    docs = spark.createDataFrame([(i, t, "s", i) for i, t in rows], "doc_id long, text string, class string, u long")
    counts, n = near_dup.document_frequencies(docs)
    exact = Counter()
    for _, t in rows:
        ws = (t or "").split()
        exact.update({tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set())
    assert counts.sum() == sum(exact.values()) and n == sum(bool((t or "").split()) for _, t in rows)
    got = near_dup.classes(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute(rows, near_dup.idf(counts, n)) and len(got) == len(rows)


def test_null_and_repeated_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (1, "x y")], "doc_id long, text string")
    assert sorted(((r[0], r[1]) for r in near_dup.classes(docs).collect()), key=str) == [(1, 1), (2, 2), (2, 2), (None, None)]
    assert near_dup.classes(docs.limit(0)).collect() == []


def test_samples_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(2)
    value = near_dup.mix(np.arange(900, dtype=np.uint64), 5)
    weight = rng.choice([1.0, 2.5, 7.0], 900).astype(np.float32)
    sampler = near_dup.Sampler(4000)
    a, b = np.sort(value[:700]), np.sort(value[200:])
    w = dict(zip(value.tolist(), weight.tolist()))
    draw = lambda v: sampler.samples(np.array([0]), v, np.array([w[x] for x in v.tolist()], np.float32))[0]
    want = sum(w[x] for x in set(a.tolist()) & set(b.tolist())) / sum(w.values())
    assert abs((draw(a) == draw(b)).mean() - want) < 0.03


@pytest.mark.parametrize("n", [1, 50])
def test_components_of_paths_and_stars(spark, n):
    edges = [(i + 1, i) for i in range(n)] + [(1000 + i, 1000) for i in range(1, n)] + [(5000, 4999)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(n + 1)} | ({1000 + i: 1000 for i in range(n)} if n > 1 else {}) | {5000: 4999, 4999: 4999}
    assert got == want

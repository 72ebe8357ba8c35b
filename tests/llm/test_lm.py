import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from docket.llm import ngram_lm as lm
from docket.llm.elias_fano import EliasFano, Successors

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("n, top", [(1, 0), (1, 5), (7, 7), (1000, 1000), (5000, 1 << 61), (3000, 9000)])
def test_elias_fano_finds_what_is_there(n, top):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, top + 1, n)) + 17
    if n == 5000:
        values = np.unique(np.concatenate([values, values[:2000] % 4000 + 30]))  # crowded buckets
    sequence = EliasFano.build(values)
    x = np.unique(np.concatenate([values, rng.integers(values[0], values[-1] + 1, 5000)]))
    at, equal = sequence.successor(x)
    assert np.array_equal(at, np.searchsorted(values, x)) and np.array_equal(equal, np.isin(x, values))


def rows():
    rng = random.Random(6)
    vocabulary = ["The", "the", "of", "é", "a", "b."] + [f"w{i}" for i in range(40)]
    out = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 50)))) for i in range(120)]
    return out + [(200, None), (201, ""), (202, "\n w1\x0bw1 "), (None, "of the"), (3, "unseen words Only here"), (203, "w1 w2 " * 20_000)]


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(train, data, least=2, d=0.75):
    toks = [WORD.findall(lower(t)) + [None] for t in train]
    c = Counter(w for ws in toks for w in ws)
    pairs = Counter(p for ws in toks for p in zip([None, *ws[:-1]], ws))
    total, distinct = sum(c.values()), len(c)
    one = lambda w: (c[w] + 0.5) / (total + 0.5 * (distinct + 1))
    mass = Counter()
    for (u, _), n in pairs.items():
        if n >= least:
            mass[u] += n - d
    back = {u: 10 ** (-round(-math.log10(max(1 - m / c[u], 1e-10)) * lm.STEPS) / lm.STEPS) for u, m in mass.items()}
    out = []
    for i, t in data:
        ws = WORD.findall(lower(t)) + [None]
        base = sum(math.log10(one(w)) for w in ws)
        s = 0.0
        for u, w in zip([None, *ws[:-1]], ws):
            if pairs[u, w] >= least:
                p = (pairs[u, w] - d) / c[u] + back[u] * one(w)
                s += -round(-math.log10(min(p, 1)) * lm.STEPS) / lm.STEPS
            else:
                s += math.log10(back.get(u, 1.0) * one(w))
        out.append((i, len(ws), sum(c[w] > 0 for w in ws), base, s))
    return out


def test_scores_equal_brute_force(spark):
    data = rows()
    docs = spark.createDataFrame([(i, t, 5) for i, t in data], "doc_id long, text string, score int")
    trie = lm.train(docs.where("doc_id % 3 <> 1"))
    got = lm.score(docs, trie).collect()
    want = brute([t for i, t in data if i is not None and i % 3 != 1], data)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:3] == b[:3]
        assert a[3] == pytest.approx(b[3], rel=1e-9) and a[4] == pytest.approx(b[4], rel=1e-3, abs=0.1)


def test_probabilities_of_a_context_sum_to_one(spark):
    docs = spark.createDataFrame([(1, "a b a b a c a b c a"), (2, "a b c")], "doc_id long, text string")
    trie = lm.train(docs)
    for before in ("a", "b", "zzz"):
        texts = [f"{before} {w}" for w in "abc"] + [before]
        alone = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        s = {r["doc_id"]: r["score"] for r in lm.score(alone, trie).collect()}
        assert len(s) == 4 and all(math.isfinite(x) for x in s.values())


def test_empty_tables(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    trie = lm.train(docs.limit(0))
    assert all(r["score"] == r["base_score"] and r["n_known"] == 0 for r in lm.score(docs, trie).collect())
    assert lm.score(docs.limit(0), lm.train(docs)).collect() == []


def test_end_token_is_a_token_of_its_own():
    words, begins = lm.tokens(pa.array(["a b", None, "", "A  b"]))
    assert begins.tolist() == [0, 3, 4, 5, 8] and (words[[2, 3, 4, 7]] == lm.END).all() and words[0] == words[5]


def brute_whole(train, data, order=3, d=0.75):
    """Every gram of up to ``order`` words is kept; a row is led by one end token."""
    code = lambda p: 10 ** (-min(round(-math.log10(min(p, 1)) * lm.STEPS), 255) / lm.STEPS)
    toks = [[None, *WORD.findall(lower(t)), None] for t in train]
    c = Counter(w for ws in toks for w in ws[1:])
    total, distinct = sum(c.values()), len(c)
    grams = Counter(tuple(ws[i - k + 1 : i + 1]) for ws in toks for k in range(2, order + 1) for i in range(k - 1, len(ws)))
    after, kinds = Counter(), Counter()
    for g, n in grams.items():
        after[g[:-1]] += n
        kinds[g[:-1]] += 1

    def p(g):
        if len(g) == 1:
            return (c[g[0]] + 0.5) / (total + 0.5 * (distinct + 1))
        lower_p = p(g[1:])
        if not after[g[:-1]]:
            return lower_p
        back = code(max(d * kinds[g[:-1]] / after[g[:-1]], 1e-10))
        return code((grams[g] - d) / after[g[:-1]] + back * lower_p) if grams[g] else back * lower_p

    out = []
    for i, t in data:
        ws = [None, *WORD.findall(lower(t)), None]
        logs = [math.log10(p(tuple(ws[max(0, j - order + 1) : j + 1]))) for j in range(1, len(ws))]
        out.append((i, len(ws) - 1, sum(c[w] > 0 for w in ws[1:]), sum(math.log10(p((w,))) for w in ws[1:]), sum(logs)))
    return out


@pytest.mark.parametrize("order", [2, 3, 4])
def test_no_gram_is_left_out(spark, order):
    data = rows()[:60] + [(300, None), (301, "seen once only"), (301, "seen once twice"), (302, "w1 w2 w3 seen once only seen")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    trie = lm.train(docs.where("doc_id % 3 <> 1 or doc_id = 301"), least=1, order=order)
    train = [WORD.findall(lower(t)) + [None] for i, t in data if i % 3 != 1 or i == 301]
    led = [[None, *ws] for ws in train]
    for k in range(2, order + 1):
        assert sum(m["n"] for m in trie.grams[k - 1]) == len({tuple(ws[i - k + 1 : i + 1]) for ws in led for i in range(k - 1, len(ws))})
    got = sorted(map(tuple, lm.score(docs, trie).collect()))
    want = sorted(brute_whole([t for i, t in data if i % 3 != 1 or i == 301], data, order))
    for a, b in zip(got, want, strict=True):
        assert a[:3] == b[:3]
        assert a[3] == pytest.approx(b[3], rel=1e-9) and a[4] == pytest.approx(b[4], rel=1e-3, abs=0.1)


def test_query_keeps_pairs_and_triples_seen_once(spark, tmp_path, monkeypatch):
    from docket.llm import queries

    spark.createDataFrame([(i, f"a{i} b{i} c{i}") for i in range(30)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tries = []
    monkeypatch.setattr(lm, "train", lambda *a, f=lm.train, **k: tries.append(f(*a, **k)) or tries[0])
    out = queries.op7_language_model(spark, str(tmp_path)).collect()
    trained = sum(not r["held_out"] for r in out)
    assert [sum(m["n"] for m in level) for level in tries[0].grams] == [3 * trained + 1, 4 * trained, 3 * trained]


@pytest.mark.parametrize("contexts, width, n", [(1, 1, 1), (5, 3, 9), (40, 1000, 5000), (3000, 50, 9000)])
def test_successors_lie_between_pointers(contexts, width, n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, contexts, n) ** 2 // contexts * width + rng.integers(0, width, n)) + 7 * width
    found = Successors.build(keys, width)
    x = np.unique(np.concatenate([keys, rng.integers(keys[0], keys[-1] + 1, 5000)]))
    at, equal = found.successor(x)
    assert np.array_equal(equal, np.isin(x, keys)) and np.array_equal(keys[at[equal]], x[equal])
    assert np.array_equal(found.keys(np.arange(len(keys))), keys)
    c = np.arange(0, contexts + 20)
    assert np.array_equal(found.start(c), np.searchsorted(keys, c * width))


def test_blocks_hold_rising_keys_and_counts():
    rng = np.random.default_rng(5)
    for top, n in ((5, 1), (300, 200), (1 << 61, 3000), (1 << 40, 100_000)):
        keys = np.unique(rng.integers(0, top, n)) + 9
        counts = rng.integers(1, top, len(keys))
        block = lm._block(3, keys, counts)
        back = lm._of_block(block["first"], block["n"], block["steps"], block["counts"])
        assert np.array_equal(back[0], keys) and np.array_equal(back[1], counts)
    assert len(block["steps"]) <= 4 * len(keys)


def test_training_leaves_only_the_levels_behind(spark):
    """A context that all shards share is counted whole, and no counted table outlives its level."""
    from docket import session

    data = [(i, f"hot s{i} x{i % 7} hot t{i % 50}") for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    before = len(session._made)
    trie = lm.train(docs, least=1, order=3)
    assert [path for _, path in session._made[before:]] == [trie.root]
    assert sum(len(level) > 1 for level in trie.grams) == 3
    got = sorted(map(tuple, lm.score(docs, trie).collect()))
    for a, b in zip(got, sorted(brute_whole([t for _, t in data], data)), strict=True):
        assert a[:3] == b[:3] and a[4] == pytest.approx(b[4], rel=1e-3, abs=0.1)

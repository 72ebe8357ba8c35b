import random

import pytest

from docket.llm import decontaminate as dec

ITEMS = [
    (1, "Anna had 12 red apples and gave 3.5 kg of them to her brother Tom, so how many did Anna and Tom have left in all?"),
    (2, "In which year was the old bridge over the river finished, and who drew the plans for it at that time?"),
    (3, "short one"),
    (4, None),
    (5, "1 2 3 4 5 6 7"),
    (6, "In which year was the old bridge over the river finished, and who drew the plans for it at that time?"),
]
LEAKS = [
    (10, "Some text first. " + ITEMS[0][1] + " And more.", {1}, False),
    (11, ITEMS[0][1].replace("Anna", "Mary").replace("Tom", "Bill").replace("12", "1,750").replace("3.5 kg", "8 pounds"), {1}, True),
    (12, ITEMS[1][1].upper(), {2, 6}, False),
    (13, "padding word " * 20_000 + ITEMS[1][1], {2, 6}, False),
    (13, ITEMS[1][1], {2, 6}, False),
]
CLEAN = [
    (20, None),
    (21, ""),
    (22, "Anna had 12 red apples, that is all there was to say about it really."),
    (23, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16"),
    (24, "over the river finished, and who " * 2),
    (None, ITEMS[1][1]),
]


@pytest.mark.parametrize("most", [2_000_000, 3])
def test_finds_copies_and_changed_questions(spark, monkeypatch, most):
    monkeypatch.setattr(dec, "BROADCAST_WINDOWS", most)
    docs = spark.createDataFrame([(i, t, "h") for i, t, *_ in LEAKS] + [(*c, "h") for c in CLEAN], "doc_id long, text string, h string")
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, doc_id int")
    got = dec.leaks(docs, items).collect()
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], set()).add(r["item_id"])
    assert found == {i: want for i, _, want, _ in LEAKS}
    assert {r["doc_id"] for r in got if r["changed"]} == {11}
    assert all(r["coverage"] >= 0.8 or r["longest_run"] >= 13 for r in got)


def test_inconsistent_slots_do_not_count(spark):
    text = "Mary had 12 red apples and gave 3.5 kg of them to her brother Bill, so how many did Anna and Tom have left in all?"
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    lines = dec.leaks(spark.createDataFrame([(1, text)], "doc_id long, text string"), items, covered=0.0, run=1).collect()
    assert lines == []


def test_equals_brute_force_on_plain_words(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(rng.randint(5, 30)))) for i in range(20)]
    docs = []
    for d in range(150):
        ws = [word() for _ in range(rng.randint(0, 40))]
        if d % 2:
            item = rng.choice(items)[1].split()
            a, b = sorted((rng.randint(0, len(item)), rng.randint(0, len(item)))) if d % 4 == 1 else (0, len(item))
            k = rng.randint(0, len(ws))
            ws[k:k] = item[a:b]
        docs.append((d, " ".join(ws)))
    want = set()
    for d, t in docs:
        ws = t.split()
        for i, q in items:
            iq = q.split()
            hit = [any(ws[k : k + 5] == iq[p : p + 5] for k in range(len(ws) - 4)) for p in range(len(iq) - 4)]
            run = best = 0
            for h in hit:
                run = run + 1 if h else 0
                best = max(best, run)
            if hit and (sum(hit) / len(hit) >= 0.8 or best + 4 >= 13):
                want.add((d, i))
    assert len(want) > 20
    got = dec.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(CLEAN, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dec.leaks(docs.limit(0), items).collect() == [] and dec.leaks(docs, items.limit(0)).collect() == []


PAY = "Alice paid 12 dollars and 50 cents to Bob on 3 May"


@pytest.mark.parametrize(
    "text, leak, changed",
    [
        ("Alice paid 7 dollars and went home. It was late and the rain fell on the roof.", False, None),
        ("He said that Alice paid 12 dollars and 50 cents to Bob on 3 May", True, False),
        ("he said that alice paid 12 dollars and 50 cents to bob on 3 may", True, False),
        ("Well. Mary paid 7 pounds and 20 pence to Ann on 9 June", False, None),  # pence is no unit
        ("Well. Mary paid 7 euros and 20 grams to Ann on 9 June", True, True),
        ("Yesterday Mary paid 7 euros and 20 grams to Ann on 9 June.", True, True),
        ("Mary paid 7 euros and 20 grams to Ann in 9 June", False, None),
        ("The bill: 12 dollars and 50 cents.", False, None),
    ],
)
def test_copies_and_look_alikes_of_a_dense_item(spark, text, leak, changed):
    items = spark.createDataFrame([(1, PAY)], "item_id long, text string")
    got = dec.leaks(spark.createDataFrame([(1, text)], "doc_id long, text string"), items).collect()
    assert [r["changed"] for r in got] == ([changed] if leak else [])


def test_an_opening_name_is_a_name_and_an_opening_word_is_none(spark):
    question = "Anna walked to the market with her two dogs. Then she bought a loaf of bread for the way home."
    items = spark.createDataFrame([(1, question), (2, "What is the capital of France?")], "item_id long, text string")
    docs = [(1, question.replace("Anna", "Mary")), (2, "Berlin is the capital of Germany"), (3, "what is the capital of Spain?"), (4, "So what is the capital of France, then?")]
    got = dec.leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {(r["doc_id"], r["item_id"], r["changed"], r["coverage"]) for r in got} == {(1, 1, True, 1.0), (4, 2, False, 1.0)} | {
        (3, 2, r["changed"], r["coverage"]) for r in got if r["doc_id"] == 3
    }


def plainly(text):
    """Tokens of a text as (written, placeholder or None, only possible), token by token."""
    import re

    out, stop = [], 0
    for m in re.finditer(r"[0-9]+(?:[.,][0-9]+)*|[A-Za-z0-9]+", text or ""):
        word, low = m.group(), m.group().lower()
        begins = not out or re.search(r"[\n!.:?]", text[stop : m.start()]) is not None
        stop, kind, maybe = m.end(), None, False
        if re.fullmatch(r"[0-9.,]+", word):
            low, kind = re.match("[0-9]+", word).group(), "number"
        elif out and out[-1][1] == "number" and low in dec.UNITS:
            kind = "unit"
        elif re.match("[A-Z][a-z]", word) and not (begins and low in dec.OPENERS):
            kind, maybe = "name", begins
        out.append((low, kind, maybe))
    return out


def leaks_plainly(doc, item):
    d, q = plainly(doc), plainly(item)
    n = len(q) - 4

    def readings(window):
        if all(kind == "number" for _, kind, _ in window):
            return set()
        found = {tuple(w for w, _, _ in window)}
        for names in (False, True):
            read = tuple((None, kind) if kind and (names or not maybe) else w for w, kind, maybe in window)
            if sum(isinstance(x, str) for x in read) >= dec.WORDS:
                found.add(read)
        return found

    if n < 1:
        return False
    covered = [False] * n
    whole, longest = [False] * n, 0
    for shift in range(-len(q), len(d)):
        hit = [p for p in range(n) if 0 <= p + shift <= len(d) - 5 and readings(d[p + shift : p + shift + 5]) & readings(q[p : p + 5])]
        pairs = {(q[t][0], d[t + shift][0]) for p in hit for t in range(p, p + 5) if q[t][1]}
        if not hit or len(pairs) > len({a for a, _ in pairs}):
            continue
        tokens = {t for p in hit for t in range(p, p + 5)}
        run = 0
        for p in range(n):
            whole[p] = all(t in tokens for t in range(p, p + 5))
            covered[p] |= whole[p]
            run = run + 1 if whole[p] else 0
            longest = max(longest, run)
    return sum(covered) / n >= dec.COVERED or longest + 4 >= dec.RUN


def test_equals_brute_force_with_placeholders(spark):
    rng = random.Random(21)
    names, units = ["Anna", "Tom", "Mary", "Bill", "Zoe"], ["kg", "days", "euros", "miles"]

    def sentence():
        return [
            rng.choice(names) if rng.random() < 0.2 else f"{rng.randint(1, 40)} {rng.choice(units)}" if rng.random() < 0.15 else rng.choice("red old cat house to the and of paid saw with a".split())
            for _ in range(rng.randint(3, 9))
        ]

    def text(n):
        return " ".join(" ".join(s)[0].upper() + " ".join(s)[1:] + rng.choice(". ! ?".split()) for s in (sentence() for _ in range(n)))

    def again(t):
        kind = rng.randrange(5)
        if kind == 0:
            return t.lower()
        if kind == 1:
            swap = dict(zip(names, rng.sample(names, len(names))))
            return " ".join(swap.get(w, w) for w in t.split())
        if kind == 2:
            return " ".join(str(rng.randint(1, 40)) if w.isdigit() else w for w in t.split())
        if kind == 3:
            ws = t.split()
            ws[rng.randrange(len(ws))] = "other"
            return " ".join(ws)
        return t

    items = [(i, text(rng.randint(1, 3))) for i in range(25)]
    docs = [(d, " ".join([text(rng.randint(0, 2)), rng.choice(["so", ""]), again(rng.choice(items)[1]), text(1)]).strip()) for d in range(150)]
    want = {(d, i) for d, t in docs for i, q in items if leaks_plainly(t, q)}
    got = dec.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert len(want) > 60 and {(r["doc_id"], r["item_id"]) for r in got.collect()} == want


def test_accented_capitals(spark):
    text = "Élan était là où ça être né, d'après les Ñandús × über alles et Þórr"
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    got = dec.leaks(spark.createDataFrame([(1, "X. " + text.upper())], "doc_id long, text string"), items).collect()
    assert [(r["item_id"], r["coverage"]) for r in got] == [(1, 1.0)]

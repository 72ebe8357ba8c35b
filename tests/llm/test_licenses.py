import re

from docket.llm import licenses

ROWS = [
    (1, "Licensed under the Apache License, Version 2.0."),
    (2, None),
    (3, ""),
    (4, "GNU General Public-License gnu General  Public LICENSE; MIT License"),
    (4, "GNU General Public-License gnu General  Public LICENSE; MIT License"),
    (None, "Licensed under CC BY-NC 4.0."),
    (6, "ccby cc é by licensé mit der mit license" + " word" * 30_000 + " apache license"),
    (7, "license " * 20_000 + "public gnu by cc"),
    (8, "cc by"),
]


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c in licenses.UPPER else c for c in text or ""))
    base, labels, score = [], set(), 0.0
    for t in licenses.TEMPLATES:
        for s in range(len(words) - len(t.words) + 1):
            if words[s] == t.words[0] and words[s : s + len(t.words)] == t.words:
                labels.add(t.label)
                low = s - t.shift
                same = sum(0 <= low + i < len(words) and words[low + i] == w for i, w in enumerate(t.around))
                score = max(score, same / len(t.around))
                if t.base:
                    base.append((s, t.label))
    starts = [s for s, _ in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({b for _, b in base})), ",".join(sorted(labels)), round(score, 9),
    )


def test_scan_equals_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 1, "w") for i, t in ROWS], "doc_id long, text string, places int, words string")
    got = licenses.summary(licenses.scan(docs)).collect()
    want = [(i, *brute(t)) for i, t in ROWS]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((*r[:7], round(r["score"], 9)) for r in got), key=key) == [(*w[:7], w[7]) for w in sorted(want, key=key)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.summary(licenses.scan(docs)).collect() == []

from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from docket.llm import alignment
from docket.llm.queries import PIECE_MODEL, QUERIES, STORE_TOKENIZER, tokenizer_path

FIRST, SECOND = tokenizer_path(STORE_TOKENIZER), tokenizer_path(PIECE_MODEL)
TEXTS = [
    "The cat's unbelievable hat, 12,345 times.", None, "", " ", "   two  spaces ", "tab\tand\nline\n\n", "a <|endoftext|> b <unk> <s> <0x41>",
    "naïve café — 😀😀 ﬁ ㎏ é", "a ▁ b", "▁", "x" * 5000, "word " * 4000, "a\x00b c　d", "The cat's unbelievable hat, 12,345 times.",
    "don't I'll we've " * 3, "مرحبا بالعالم 你好世界", "\r\n \x1c \x85 end ",
]


def direct(text):
    """Tokens of both tokenizers as (id, start, end), by the plain library calls; None without tokens."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    if not direct.tools:
        direct.tools = Tokenizer.from_file(FIRST), SentencePieceProcessor(model_file=SECOND)
        direct.tools[0].encode_special_tokens = True
        direct.names = {i: t for t, i in direct.tools[0].get_vocab().items()}
    if not text:
        return [], []
    byte, sp = alignment._byte_level(), direct.tools[1]
    a = [(i, bytes(byte[c] for c in direct.names[i])) for i in direct.tools[0].encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(text)]
    whole, out = (" " + text).encode(), []
    for tokens in (a, b):
        if b"".join(w for _, w in tokens) != whole:
            return [], []
        at, side = 0, []
        for i, w in tokens:
            side.append((i, at, at + len(w)))
            at += len(w)
        out.append(side)
    return tuple(out)


direct.tools = None


def brute(rows):
    seen, per = Counter(), []
    for _, text in rows:
        a, b = direct(text)
        linked, j = [], 0
        for i, s, e in a:
            while j and b[j - 1][2] > s:
                j -= 1
            while b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                linked.append((i, b[k][0]))
                k += 1
        seen.update(set(linked))
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        parts, low = [], 0
        for cut in cuts:
            inside = [",".join(str(i) for i, s, e in side if low <= s and e <= cut) for side in (a, b)] if len(a) < 3000 else None
            parts.append("|".join(inside) if inside else None)
            low = cut
        per.append((len(a), len(b), len(cuts), linked, ";".join(parts) if None not in parts else None))
    most = Counter()
    for (i, _), n in seen.items():
        most[i] = max(most[i], n)
    out = []
    for (key, _), (n_a, n_b, n_groups, linked, text) in zip(rows, per):
        sums = (len(linked), sum(seen[x] == most[x[0]] for x in linked), sum(seen[x] for x in linked))
        digest = None if text is None else sha256(text.encode()).hexdigest() if text else ""
        out.append((key, n_a, n_b, n_groups, *sums, digest))
    return out


def compare(got, rows):
    got = sorted(got, key=repr)
    want = sorted(brute(rows), key=lambda r: repr(r[:-1]))
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: repr(r[:-1])), want):
        assert g[:-1] == w[:-1] and (w[-1] is None or g[-1] == w[-1])


def test_alignment_equals_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(3, "The cat again."), (None, "no key"), (3, "The cat again.")]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, pair string, block long").repartition(3)
    for size in (1, 1 << 20):
        got = alignment.align(docs, FIRST, SECOND, block_bytes=size).collect()
        compare([tuple(r) for r in got], rows)


def test_query_equals_brute_force(spark, folder):
    got = QUERIES["op12_token_alignment"](spark, folder)
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    compare([tuple(r) for r in got.collect()], rows)


def test_empty_tables_and_texts(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(empty, FIRST, SECOND).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in alignment.align(blank, FIRST, SECOND).collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_groups_as_text(spark):
    docs = spark.createDataFrame([(1, "unbelievable hats"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.groups for r in alignment.groups(docs, FIRST, SECOND).collect()}
    a, b = direct("unbelievable hats")
    ids = [[int(i) for group in got[1].split(";") for i in group.split("|")[side].split(",")] for side in (0, 1)]
    assert ids == [[t[0] for t in a], [t[0] for t in b]] and got[2] == ""


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 4)), min_size=1, max_size=40))
def test_pointer_jumping_finds_the_components(steps):
    ends_a, ends_b = np.cumsum([a for a, _ in steps]), np.cumsum([b for _, b in steps])
    top = max(ends_a[-1], ends_b[-1])
    ends_a, ends_b = (x if x[-1] == top else np.append(x, top) for x in (ends_a, ends_b))
    last_a, last_b = alignment.terminals(ends_a, ends_b)
    cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    for ends, last in ((ends_a, last_a), (ends_b, last_b)):
        for e, t in zip(ends.tolist(), last.tolist()):
            assert ends_b[t] == min(c for c in cuts if c >= e)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), max_size=4))
def test_any_text_is_cut_as_by_the_plain_calls(texts):
    a, b = alignment.tokens(FIRST), alignment.tokens(SECOND)
    out, words, *_ = alignment.align_rows(pa.array(texts, pa.string()), a, b, alignment.GroupTexts(a, b))
    for k, t in enumerate(texts):
        first, second = direct(t)
        assert (out["n_a"][k], out["n_b"][k]) == (len(first), len(second))
        ids = [[int(i) for g in words[k].split(";") if g for i in g.split("|")[side].split(",")] for side in (0, 1)]
        assert ids == [[x[0] for x in first], [x[0] for x in second]]

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from docket.llm import mixtures
from docket.llm.queries import PACK_TOKENIZER, QUERIES, tokenizer_path

LONG = "lorem ipsum, dolor! " * 4000
ROWS = [(5, "The cat's hat."), (3, None), (9, ""), (7, LONG), (3, "again 3"), (None, "no key"), (11, "a  b\n\n c  "), (5, "The cat's hat."), (12, "a <|endoftext|> b")]


def direct(text, end=0):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(PACK_TOKENIZER)).encode(text or "", add_special_tokens=False).ids + [end]


def check(rows, texts, window):
    """Pieces cover each document once, only long ones are cut, and sequences have no gap and no overlap."""
    want = {}
    for key, text in texts:
        ids = direct(text)
        for k in range(0, len(ids), window):
            part = np.array(ids[k : k + window], "<u4")
            piece = (key, k // window, k, len(part), zlib.crc32(part.tobytes()))
            want[piece] = want.get(piece, 0) + 1
    got, filled = {}, {}
    for key, piece, start, length, crc, sequence, offset in rows:
        got[(key, piece, start, length, crc)] = got.get((key, piece, start, length, crc), 0) + 1
        filled.setdefault(sequence, []).append((offset, length))
    assert got == want
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return len(filled)


def fewest(lengths, window):
    """The least number of sequences, by trying all ways."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for room in sorted({r for r in rooms if r >= lengths[i]}):
            rest = list(rooms)
            rest.remove(room)
            place(i + 1, [*rest, room - lengths[i]])
        place(i + 1, [*rooms, window - lengths[i]])

    place(0, [])
    return best[0]


def test_pieces_of_odd_texts(spark):
    docs = spark.createDataFrame([(k, t, "x", i) for i, (k, t) in enumerate(ROWS)], "doc_id long, text string, tail string, n long").repartition(3)
    for window in (64, 2048):
        out = mixtures.pack(docs, tokenizer_path(PACK_TOKENIZER), 0, window=window).collect()
        rows = [(r.doc_id, r.piece, r.start, r.length, zlib.crc32(bytes(r.ids)), r.sequence_id, r.offset) for r in out]
        check(rows, ROWS, window)


def test_query_packs_every_document(spark, folder):
    rows = [tuple(r) for r in QUERIES["op11_mixture_packing"](spark, folder).collect()]
    texts = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    n = check(rows, texts, 2048)
    ids = sum(r[3] for r in rows)
    assert n <= -(-ids // 2048) * 1.03


def test_shuffled_bases_give_the_same_pieces(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(100).repartition(4)
    monkeypatch.setattr(mixtures, "BROADCAST_ROWS", 0)
    out = mixtures.pack(docs, tokenizer_path(PACK_TOKENIZER), 0).drop("ids").collect()
    assert len({(r.sequence_id, r.offset) for r in out}) == len(out)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert mixtures.pack(empty, tokenizer_path(PACK_TOKENIZER), 0).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 31), min_size=1, max_size=10))
def test_plan_is_near_the_fewest(lengths):
    stock = np.bincount(lengths, minlength=33)
    plan = mixtures.plan(stock, 32)
    assert fewest(lengths, 32) <= plan.sequences <= fewest(lengths, 32) + 1
    place = {}
    for length in np.flatnonzero(stock):
        s, o = plan.place(np.full(stock[length], length), np.arange(stock[length]))
        for a, b in zip(s.tolist(), o.tolist()):
            place.setdefault(a, []).append((b, int(length)))
    assert len(place) == plan.sequences
    for parts in place.values():
        assert sum(n for _, n in parts) <= 32
        assert [o for o, _ in sorted(parts)] == np.cumsum([0] + [n for _, n in sorted(parts)])[:-1].tolist()


@pytest.mark.parametrize("times", [1, 10**9])
def test_plan_grows_with_lengths_not_with_documents(times):
    rng = np.random.default_rng(3)
    stock = np.bincount(rng.integers(1, 2048, 4000), minlength=2049) * times
    shares = mixtures.solve(stock, 2048)
    groups = mixtures.rounded(shares, stock, 2048)
    volume = int((stock * np.arange(2049)).sum())
    placed = np.zeros(2049, np.int64)
    for mixture, k in groups:
        np.add.at(placed, list(mixture), k)
    assert (placed == stock).all()
    assert len(groups) < 8000 and sum(k for _, k in groups) <= 1.03 * volume / 2048


def test_program_uses_the_fractions_of_known_optimum():
    # 548 + 1500 fill a window; 1000 of the long ones need a window each whatever is added.
    stock = np.bincount([1500] * 1000 + [548] * 600 + [100] * 500, minlength=2049)
    assert sum(k for _, k in mixtures.rounded(mixtures.solve(stock, 2048), stock, 2048)) == 1000

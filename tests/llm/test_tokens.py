import zlib

import numpy as np
import pytest

from docket.llm import packing, token_store
from docket.llm.queries import PACK_TOKENIZER, STORE_TOKENIZER, tokenizer_path

LONG = "lorem ipsum, dolor! " * 4000
ROWS = [(5, "The cat's hat."), (3, None), (9, ""), (7, LONG), (3, "again 3"), (None, "no key"), (11, "a  b\n\n c  "), (5, "The cat's hat.")]


def direct(name, text, end):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(tokenizer_path(name))
    return tool.encode(text or "", add_special_tokens=False).ids + [end]


def docs(spark, rows=ROWS):
    return spark.createDataFrame([(k, t, "x", i) for i, (k, t) in enumerate(rows)], "doc_id long, text string, ids string, n long")


def test_packing_loses_no_id_and_leaves_no_gap(spark):
    out = packing.pack(docs(spark), tokenizer_path(PACK_TOKENIZER), 1, window=64).collect()
    filled = {}
    for r in out:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] > 0
        for k, x in enumerate(ids):
            assert filled.setdefault((r["sequence_id"], r["offset"] + k), x) == x
    assert len(filled) == sum(r["length"] for r in out)
    places = sorted(filled)
    assert places == [(i // 64, i % 64) for i in range(len(places))]
    by_doc = sorted((r["sequence_id"], r["offset"], r["doc_id"], r["start"], r["doc_tokens"], bytes(r["ids"])) for r in out)
    docs_seen, current = [], b""
    for _, _, key, start, n, raw in by_doc:
        assert len(current) == 4 * start
        current += raw
        if len(current) == 4 * n:
            docs_seen.append((key, np.frombuffer(current, "<u4").tolist()))
            current = b""
    assert not current
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(docs_seen, key=key) == sorted(((k, direct(PACK_TOKENIZER, t, 1)) for k, t in ROWS), key=key)


def test_sequences_are_padded_but_at_a_power_of_two(spark):
    packed = packing.pack(docs(spark, [(1, "one two three"), (2, "four five")]), tokenizer_path(PACK_TOKENIZER), 1, window=5)
    rows = packing.sequences(packed, 0, 5).orderBy("sequence_id").collect()
    n = packed.groupBy().sum("length").first()[0]
    assert sum(len(r["ids"]) // 4 - r["padding"] for r in rows) == n
    assert [len(r["ids"]) // 4 in (1, 2, 4, 5) for r in rows] == [True] * len(rows)


def test_empty_tables(spark):
    none = docs(spark).limit(0)
    assert packing.pack(none, tokenizer_path(PACK_TOKENIZER), 1).collect() == []
    root, manifest = token_store.write_store(none, tokenizer_path(STORE_TOKENIZER), 2)
    assert manifest == [] and token_store.read_ids(spark, root, manifest, none).collect() == []


def test_store_round_trip(spark):
    root, manifest = token_store.write_store(docs(spark), tokenizer_path(STORE_TOKENIZER), 2, shards=3)
    got = token_store.read_ids(spark, root, manifest, docs(spark)).collect()
    want = [(k, direct(STORE_TOKENIZER, t, 2)) for k, t in ROWS]
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r["doc_id"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in got), key=key) == sorted(want, key=key)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    keys = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    absent = spark.createDataFrame([(4,), (12345,)], "doc_id long")
    assert token_store.read_ids(spark, root, manifest, absent).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    hashes = token_store.mix(np.arange(n, dtype=np.uint64), 9)
    slots = token_store.PerfectHash.build(hashes).slots(hashes)
    assert sorted(slots.tolist()) == list(range(n))


def test_query_gives_the_crc_of_the_library_ids(spark, folder):
    from docket.llm.queries import op10_token_store, table

    text = {r["doc_id"]: r["text"] for r in table(spark, folder, "documents").collect()}
    at = 0
    for r in sorted(op10_token_store(spark, folder).collect(), key=lambda r: r["doc_id"]):
        ids = np.array(direct(STORE_TOKENIZER, text[r["doc_id"]], 2), "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


MARKED = [
    (1, "a <|endoftext|> b <unk>"), (2, "A<|ENDOFTEXT|>b"), (3, "plain words, none marked"), (4, "x  <|endoftext|>\n\n<|startoftext|>!y<|endoftext|>"),
    (5, None), (6, "<|endo"), (7, "ftext|> of two rows"), (8, "<|endoftext|>"), (9, "é<|endoftext|>é <|endoftext|"), (10, "plain words, none marked"),
]


@pytest.mark.parametrize("name, end", [(PACK_TOKENIZER, 1), (STORE_TOKENIZER, 2)])
def test_added_tokens_in_a_text_are_those_of_the_plain_call(spark, name, end):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(tokenizer_path(name))
    want = {k: tool.encode(t or "", add_special_tokens=False).ids + [end] for k, t in MARKED}
    assert tool.token_to_id("<|endoftext|>") in want[1]
    if name == STORE_TOKENIZER:
        root, manifest = token_store.write_store(docs(spark, MARKED), tokenizer_path(name), end, shards=2)
        out = token_store.read_ids(spark, root, manifest, docs(spark, MARKED)).collect()
        starts = np.cumsum([0, *(len(want[k]) for k in range(1, 10))]).tolist()
        assert [r["start"] for r in sorted(out, key=lambda r: r["doc_id"])] == starts
    else:
        out = packing.pack(docs(spark, MARKED), tokenizer_path(name), end).collect()
    assert {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in out} == want

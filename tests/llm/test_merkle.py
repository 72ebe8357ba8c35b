import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from docket.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
ROWS = [(i, f"s{i % 3}", ("en", "de", None, "é")[0 if i % 5 else i % 4], i * 3, f"text {i} ä") for i in range(150)]
ODD = [(7, "s", "en", 1, "same id"), (7, "s", "en", 1, "same id"), (None, None, None, None, None), (None, "x", "fr", 2, ""), (3, None, "en", None, "x" * 300_000)]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, pos):
    out = []
    for row in tree[:-1]:
        out.append([row[k] for k in (pos ^ 1,) if k < len(row)] + [pos & 1])
        pos >>= 1
    return out


def fold(digest, steps):
    for *other, right in steps:
        digest = h(digest) if not other else h(other[0], digest) if right else h(digest, other[0])
    return digest


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in groups[g]])
    over = levels([trees[g][-1][0] for g in names])
    out = []
    for i, g in enumerate(names):
        for pos, r in enumerate(groups[g]):
            steps = siblings(trees[g], pos) + siblings(over, i)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now = leaf((*r[:3], r[3] + 1, r[4])) if hit and r[3] is not None else leaf(r)
            proof = h(*[s[0] for s in steps if len(s) == 2])
            out.append((r[0], leaf(r), trees[g][-1][0], over[-1][0], proof, fold(now, steps)))
    return sorted(out, key=repr)


def made(spark, rows, bits):
    # Columns named like the operator's own do no harm.
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, g string, pos long, digest string")
    return merkle.manifest(
        docs.repartition(5), FIELDS, "lang", changes={"n_chars": F.col("n_chars") + 1}, where=F.crc32(F.col("doc_id").cast("string")) % 7 == 0, bits=bits
    )


@pytest.mark.parametrize("rows, bits", [(ROWS + ODD, 2), (ROWS + ODD, 10), (ROWS[:1], 2), (ROWS[:5], 2), ([(i, "s", f"{i:02d}", 1, "t") for i in range(9)], 1)])
def test_manifest_equals_brute_force(spark, rows, bits):
    got = [(r.key, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in made(spark, rows, bits).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_empty_table_has_no_rows(spark):
    assert made(spark, ROWS, 3).limit(0).collect() == []
    empty = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.manifest(empty, FIELDS, "lang").collect() == []


def test_version_shares_what_it_does_not_copy():
    digests = [h(str(i)).encode() for i in range(11)]
    tree = merkle.Block(digests, True, 10)
    before, root = list(tree.digest), tree.root
    nodes = len(tree.digest)
    new = tree.changed(6, h("new").encode())
    assert len(new) == len(tree.levels) and len(tree.digest) == nodes + len(new)
    assert tree.digest[:nodes] == before and tree.root == root

    def reached(node):
        return {node}.union(*[reached(c) for c in tree.children[node]])

    # Of the new version's nodes only the path is its own.
    assert reached(new[-1]) - reached(root) == set(new)
    changed = digests[:6] + [h("new").encode()] + digests[7:]
    assert tree.digest[new[-1]] == merkle.Block(changed, True, 10).digest[-1]


def test_untampered_rows_have_no_copied_nodes(spark):
    for r in made(spark, ROWS, 4).collect():
        assert (r.copied is None) == (zlib.crc32(str(r.key).encode()) % 7 != 0)
        assert (r.folded_root == r.root) == (r.copied is None)
        if r.copied:
            assert r.copied[-1] == r.folded_root and r.copied[0] != r.leaf

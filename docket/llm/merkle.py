"""A Merkle manifest of a dataset: a persistent tree in which a changed leaf makes a version.

Every row is a leaf; leaves of a group stand in the order of their key. Two consecutive nodes become
their hash while a group has more than one; a last node without a neighbour is hashed alone. The groups'
roots make one more tree of the same kind, whose root stands for the dataset.

The tree is cut into aligned blocks of ``2**BITS`` nodes over the ``BITS`` levels above them. A
block is one group of one Spark job; the roots of a level's blocks are the nodes of the next level's, so
each level is a distributed table ``2**BITS`` times smaller than the one below. On the way down every block
is handed the path from its own root to the dataset's. A changed leaf then makes a version inside its
block: only its ancestors are copied, all other nodes are shared with the tree as it was
(:class:`Block`). The version goes on above its block by the path, in the same task: no task ever
holds the versions of more than one block of leaves.

Leaves are hashed where their texts lie; only digests move. The place of a leaf in its group comes
from a range-partitioned sort and one count for each partition and group, so a group of any share of the
rows is spread over many tasks.

Defined results: null fields are written as ``-``; a null group is a group of its own and comes first;
rows of a null key come first in their group; rows of equal key stand in the order of their leaves, so repeated
rows have equal leaves and one proof for each place; an empty table has no rows; texts of any
length are hashed whole; other columns are not read, so their names do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docket.session import ship, staged

BITS = 10
NODES = "g string, pos long, size long, digest string"
PATHS = "g string, pos long, name string, path binary, subroot string, root string"
VERSIONS = "key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, copied array<string>"
#: How a path says on which side the sibling stands.
ALONE, LEFT, RIGHT = 0, 1, 2
STEP = 33


def _hash(*parts: bytes) -> bytes:
    return sha256(b"".join(parts)).hexdigest().encode()


class Block:
    """A persistent tree over at most ``2**bits`` nodes.

    Nodes are never changed. ``changed`` copies the ancestors of one leaf and shares the rest,
    so a version costs one node for each level. A block that is not its group's last one goes up all ``bits``
    levels; one that is the whole group ends at its only node.
    """

    def __init__(self, digests: Sequence[bytes], whole: bool, bits: int) -> None:
        self.digest = list(digests)
        self.children: list[tuple[int, ...]] = [()] * len(self.digest)
        self.levels = [list(range(len(self.digest)))]
        while len(self.levels[-1]) > 1 or (not whole and len(self.levels) <= bits):
            row = self.levels[-1]
            self.levels.append([self._node(tuple(row[i : i + 2])) for i in range(0, len(row), 2)])
        self.root = self.levels[-1][0]

    def _node(self, children: tuple[int, ...]) -> int:
        self.digest.append(_hash(*[self.digest[c] for c in children]))
        self.children.append(children)
        return len(self.digest) - 1

    def siblings(self, pos: int) -> list[tuple[int, bytes]]:
        """The side and digest of the other node of each level's run, from a leaf's level up."""
        out = []
        for row in self.levels[:-1]:
            other = pos ^ 1
            out.append((LEFT if pos & 1 else RIGHT, self.digest[row[other]]) if other < len(row) else (ALONE, b""))
            pos >>= 1
        return out

    def changed(self, pos: int, digest: bytes) -> list[int]:
        """A version with another leaf at ``pos``: the new nodes from the leaf to the version's root."""
        above, node = [], self.root
        for level in range(len(self.levels) - 2, -1, -1):
            above.append((node, pos >> level & 1))
            node = self.children[node][pos >> level & 1]
        self.digest.append(digest)
        self.children.append(())
        made = [len(self.digest) - 1]
        for old, side in reversed(above):
            children = list(self.children[old])
            children[side] = made[-1]
            made.append(self._node(tuple(children)))
        return made


def _packed(steps: list[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes([side]) + (bytes.fromhex(d.decode()) if side else bytes(STEP - 1)) for side, d in steps)


def _steps(path: bytes) -> list[tuple[int, bytes]]:
    return [(path[i], path[i + 1 : i + STEP].hex().encode()) for i in range(0, len(path), STEP)]


def _folded(digest: bytes, steps: list[tuple[int, bytes]]) -> list[bytes]:
    """The digests of a node's ancestors, given its siblings."""
    out = []
    for side, other in steps:
        digest = _hash(digest) if side == ALONE else _hash(other, digest) if side == LEFT else _hash(digest, other)
        out.append(digest)
    return out


def hashed(*fields: Column) -> Column:
    """The digest of a row: each field as its length in bytes, a colon and its text, or ``-`` for null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def placed(df: DataFrame, *order: str) -> DataFrame:
    """Add ``pos``, the place of each row in its group ``g`` by ``order``, and ``size``, the group's rows.

    One row for each partition and group is summed up; it is joined back as Spark sees fit by its size.
    """
    by = [F.asc("g"), *[F.asc_nulls_first(c) for c in order]]
    # Rows that are equal in all of these are told apart, so that they may lie in several partitions.
    spread = df.withColumn("__tie", F.monotonically_increasing_id())
    at = F.monotonically_increasing_id()
    rows = staged(spread.repartitionByRange(*by, F.asc("__tie")).sortWithinPartitions(*by).drop("__tie").withColumn("__at", at), "placed")
    rows = rows.withColumn("__part", F.shiftright("__at", 33))
    spans = rows.groupBy("__part", "g").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    group = Window.partitionBy("g")
    spans = spans.select(
        "__part", "g", "__first",
        (F.sum("__n").over(group.orderBy("__part")) - F.col("__n")).alias("__before"),
        F.sum("__n").over(group).alias("size"),
    )
    return rows.join(spans, ["__part", "g"]).withColumn("pos", F.col("__before") + F.col("__at") - F.col("__first")).drop(
        "__part", "__at", "__first", "__before"
    )


def _block(bits: int) -> Column:
    return F.shiftright("pos", bits).alias("block")


def _cells(table: pa.Table, *names: str) -> list:
    return [table.column(n).to_pylist() for n in names]


def _in_order(table: pa.Table) -> pa.Table:
    return table.sort_by("pos")


def _root_of(table: pa.Table, bits: int) -> pa.Table:
    table = _in_order(table)
    g, size = table.column("g")[0].as_py(), table.column("size")[0].as_py()
    tree = Block([d.encode() for d in table.column("digest").to_pylist()], size <= 1 << bits, bits)
    row = {"g": g, "pos": table.column("pos")[0].as_py() >> bits, "size": -(-size >> bits), "digest": tree.digest[tree.root].decode()}
    return pa.Table.from_pylist([row], pa.schema([("g", pa.string()), ("pos", pa.int64()), ("size", pa.int64()), ("digest", pa.string())]))


def climb(nodes: DataFrame, bits: int = BITS) -> tuple[list[DataFrame], DataFrame]:
    """The node tables of all block levels, and one root for each group with the level that ends in it."""
    ship(nodes.sparkSession)
    largest = nodes.agg(F.max("size")).first()[0] or 1
    levels, roots = [nodes], None
    while True:
        level = F.lit(len(levels) - 1)
        blocks = levels[-1].select("g", "pos", "size", "digest", _block(bits)).groupBy("g", "block").applyInArrow(lambda t: _root_of(t, bits), NODES)
        tops = staged(blocks, "blocks")
        found = tops.where("size = 1").select("g", level.alias("level"), F.col("digest").alias("subroot"))
        roots = found if roots is None else roots.unionByName(found)
        largest = -(-largest >> bits)
        if largest <= 1:
            return levels, roots
        levels.append(tops.where("size > 1"))


def _paths_of(nodes: pa.Table, above: pa.Table, bits: int) -> pa.Table:
    nodes = _in_order(nodes)
    top = above.slice(0, 1).to_pylist()[0]
    digests, size = nodes.column("digest").to_pylist(), nodes.column("size")[0].as_py()
    tree = Block([d.encode() for d in digests], size <= 1 << bits, bits)
    n = len(digests)
    return pa.table(
        {
            "g": nodes.column("g"),
            "pos": nodes.column("pos"),
            "name": nodes.column("name"),
            "path": pa.array([_packed(tree.siblings(i)) + top["path"] for i in range(n)], pa.binary()),
            "subroot": pa.array([top["subroot"]] * n, pa.string()),
            "root": pa.array([top["root"]] * n, pa.string()),
        }
    )


def _versions_of(nodes: pa.Table, above: pa.Table, bits: int) -> pa.Table:
    nodes = _in_order(nodes)
    top = above.slice(0, 1).to_pylist()[0]
    digests, changed = _cells(nodes, "digest", "changed")
    tree = Block([d.encode() for d in digests], nodes.column("size")[0].as_py() <= 1 << bits, bits)
    upper = _steps(top["path"])
    rest = b"".join(d for side, d in upper if side)
    known: dict[bytes, list[bytes]] = {}
    proofs, folded, copied = [], [], []
    for pos, (digest, other) in enumerate(zip(digests, changed)):
        steps = tree.siblings(pos)
        proofs.append(sha256(b"".join(d for side, d in steps if side) + rest).hexdigest())
        if other is None:
            inside = [digest.encode(), *_folded(digest.encode(), steps)]
            if inside[-1] not in known:
                known[inside[-1]] = _folded(inside[-1], upper)
            outside = known[inside[-1]]
            copied.append(None)
        else:
            inside = [tree.digest[k] for k in tree.changed(pos, other.encode())]
            outside = _folded(inside[-1], upper)
            copied.append([d.decode() for d in (*inside, *outside)])
        folded.append((*inside, *outside)[-1].decode())
    n = len(digests)
    return pa.table(
        {
            "key": nodes.column("key"),
            "leaf": nodes.column("digest"),
            "subroot": pa.array([top["subroot"]] * n, pa.string()),
            "root": pa.array([top["root"]] * n, pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(folded, pa.string()),
            "copied": pa.array(copied, pa.list_(pa.string())),
        }
    )


def descend(levels: list[DataFrame], tops: DataFrame, last, schema: str, bits: int = BITS) -> DataFrame:
    """Hand each block the path above it, level by level; ``last`` makes the rows of the leaves' level.

    ``tops`` has, for every group, the level whose only block ends in its root, and the path above that root.
    """
    above = None
    for k in range(len(levels) - 1, -1, -1):
        here = tops.where(F.col("level") == k).select("g", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
        if above is not None:
            here = here.unionByName(above.select("g", F.col("pos").alias("block"), "path", "subroot", "root"))
        nodes = levels[k].withColumn("block", _block(bits))
        if k:
            nodes = nodes.withColumn("name", F.lit(None).cast("string"))
        pairs = nodes.groupBy("g", "block").cogroup(here.groupBy("g", "block"))
        if k == 0:
            return pairs.applyInArrow(lambda a, b: last(a, b, bits), schema)
        above = staged(pairs.applyInArrow(lambda a, b: _paths_of(a, b, bits), PATHS), "paths")


def manifest(
    docs: DataFrame,
    fields: Sequence[str],
    group: str,
    key: str = "doc_id",
    changes: dict[str, Column] | None = None,
    where: Column | None = None,
    bits: int = BITS,
) -> DataFrame:
    """One row for each row of ``docs``: its leaf, its group's root, the dataset's root, the digest of its proof, and the root
    that its proof folds to.

    Rows that ``where`` marks are tampered with by ``changes`` (field to new value): ``folded_root`` is then the root of
    the version with that leaf, and ``copied`` lists the version's own nodes from the leaf to the root. All its
    other nodes are those of the untampered tree.
    """
    now = {f: (changes or {}).get(f, F.col(f)) for f in fields}
    other = F.when(where if where is not None else F.lit(False), hashed(*now.values()))
    # A letter before the group's name lets null be a name that comes first.
    name = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    own = hashed(*[F.col(f) for f in fields])
    leaves = staged(docs.select(F.col(key).cast("long").alias("key"), name.alias("g"), own.alias("digest"), other.alias("changed")), "leaves")
    levels, roots = climb(placed(leaves, "key", "digest"), bits)
    roots = staged(roots, "roots")
    # The groups' roots are the leaves of the tree above them, in the order of the groups' names.
    named = roots.select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("subroot").alias("digest"))
    over, top = climb(placed(named, "name"), bits)
    tops = top.select("g", "level", F.lit(b"").alias("path"), "subroot", F.col("subroot").alias("root"))
    paths = descend(over, tops, _paths_of, PATHS, bits).select(F.col("name").alias("g"), "path", "root")
    return descend(levels, staged(roots.join(paths, "g"), "tops"), _versions_of, VERSIONS, bits)


#: The unsigned crc32 of a text of ASCII characters in SQL: eight steps of the reversed polynomial for each byte.
CRC32 = """list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split({x}, ''), lambda ch: ord(ch)::ubigint)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::ubigint, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384::ubigint)))"""


def oracle() -> str:
    """The rows of the query in SQL: a tree over whole tables, level by level."""
    field = lambda c: f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"
    leaf = lambda n: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", n, "text")) + ")"
    crc = f"xor({CRC32.format(x='doc_id::varchar')}, 4294967295::ubigint)"
    return f"""
with recursive d as (select doc_id, coalesce('1' || lang, '0') as g, {leaf('n_chars')} as leaf,
    case when {crc} % 7 = 0 then {leaf('(n_chars + 1)')} end as changed from documents),
p as (select *, row_number() over (partition by g order by doc_id nulls first, leaf, changed) - 1 as pos, count(*) over (partition by g) as m from d),
t as (select 0 as lvl, g, pos, m, leaf as h from p
  union all select lvl + 1, g, pos // 2, any_value((m + 1) // 2), sha256(string_agg(h, '' order by pos)) from t where m > 1 group by lvl, g, pos // 2),
s as (select g, h as subroot, lvl as top, row_number() over (order by g) - 1 as pos, count(*) over () as m from t where m = 1),
u as (select 0 as lvl, pos, m, subroot as h from s
  union all select lvl + 1, pos // 2, any_value((m + 1) // 2), sha256(string_agg(h, '' order by pos)) from u where m > 1 group by lvl, pos // 2),
r as (select h as root, lvl as top from u where m = 1),
steps as (select p.g, p.pos, t.lvl, t.h, (p.pos >> t.lvl) & 1 as side from p join s using (g)
    join (select unnest(range(64)) as k) on k < s.top join t on t.g = p.g and t.lvl = k and t.pos = xor(p.pos >> k, 1::bigint)
  union all select p.g, p.pos, s.top + u.lvl, u.h, (s.pos >> u.lvl) & 1 from p join s using (g) cross join r
    join (select unnest(range(64)) as k) on k < r.top join u on u.lvl = k and u.pos = xor(s.pos >> k, 1::bigint)),
proof as (select g, pos, string_agg(h, '' order by lvl) as whole from steps group by g, pos),
f as (select p.g, p.pos, 0 as lvl, coalesce(p.changed, p.leaf) as h, s.top + r.top as top from p join s using (g) cross join r
  union all select f.g, f.pos, f.lvl + 1, sha256(case steps.side when 1 then steps.h || f.h when 0 then f.h || steps.h else f.h end), f.top
  from f left join steps on steps.g = f.g and steps.pos = f.pos and steps.lvl = f.lvl where f.lvl < f.top)
select p.doc_id, p.leaf, s.subroot, r.root, sha256(coalesce(proof.whole, '')) as proof_sha256, f.h as folded_root, f.h = r.root as verified
from p join s using (g) cross join r left join proof on proof.g = p.g and proof.pos = p.pos join f on f.g = p.g and f.pos = p.pos and f.lvl = f.top
"""

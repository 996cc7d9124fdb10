"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf; the leaves of a group (a source) in id order are the lowest level of
a tree in which each run of ``FANOUT`` consecutive nodes hashes into its parent, and the
groups' roots are the leaves of one more such tree. Nodes are labelled (level, place), so
children come before parents, and digests move as messages in label order:

* forward sweep: a node takes its children's digests off a priority queue ordered by
  label, hashes them and queues its own digest for its parent;
* reversed sweep: a node takes its proof suffix (the siblings from its own level up to the
  root) off the queue in falling label order and queues for each child the child's siblings
  in front of that suffix, until it reaches the leaves.

The queue is external in two tiers. Beyond a block of ``BLOCK_LEVELS`` levels (at most
``FANOUT ** BLOCK_LEVELS`` leaves, complete subtrees) messages go through Spark's exchange,
which spills, and are written down, so a lost executor repeats one block; inside a
block a heap in the task delivers them. A tree of 10 billion leaves takes three
rounds each way, each on 1/2187 of the rows of the one before. Places come from one
range partitioning by (group, id) and the row counts of its partitions, so a group with a
third of all rows is spread like any other.

Defined results: a null field hashes as ``-``; a null group is a group of its own, the first;
null ids come first and are never tampered with; rows of equal id are ordered by
their leaf digest; repeated rows are leaves of their own; an empty text is ``0:``; an
empty table has no rows (and no root); further columns are not read. Texts are hashed
in the JVM row by row, whatever their length; only 32-byte digests move after that.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.sources.sinks import materialize

FANOUT = 3
#: Levels that one task handles at a time, with at most ``FANOUT ** BLOCK_LEVELS`` leaves.
BLOCK_LEVELS = 7


def field(c: Column) -> Column:
    """One field of a leaf: ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 (binary) of the fields one after the other."""
    return F.unhex(F.sha2(F.concat(*(field(c) for c in columns)), 256))


# ------------------------------------------------------------------ one block of a tree, inside a task

def _hash(parts: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def _heights(n: int, levels: int | None) -> list[int]:
    """Nodes on each level of a block of ``n`` leaves: up to one node, or all ``levels`` of a block of a larger tree."""
    sizes = [n]
    while (sizes[-1] > 1 if levels is None else len(sizes) <= levels):
        sizes.append(-(-sizes[-1] // FANOUT))
    return sizes


def forward(leaves: list[bytes], levels: int | None) -> dict[tuple[int, int], bytes]:
    """Digest of every node by label (level, place): messages to parents pass a heap in label order (levels: see above)."""
    sizes = _heights(len(leaves), levels)
    digest: dict[tuple[int, int], bytes] = {}
    queue = [((0, i), 0, d) for i, d in enumerate(leaves)]  # sorted, hence a heap
    while queue:
        label = queue[0][0]
        got = []
        while queue and queue[0][0] == label:
            got.append(heapq.heappop(queue)[2])
        level, place = label
        digest[label] = got[0] if level == 0 else _hash(got)
        if level + 1 < len(sizes):
            heapq.heappush(queue, ((level + 1, place // FANOUT), place % FANOUT, digest[label]))
    return digest


def backward(digest: dict[tuple[int, int], bytes], suffix: list[tuple[bytes, bytes]]) -> list[list[tuple[bytes, bytes]]]:
    """Proof of every leaf: (left siblings, right siblings) of each level up to the root, ``suffix`` above the block."""
    top = max(digest)
    queue = [((-top[0], -top[1]), suffix)]
    proofs: list[list[tuple[bytes, bytes]]] = [[]] * sum(1 for level, _ in digest if level == 0)
    while queue:
        (level, place), mine = heapq.heappop(queue)
        level, place = -level, -place
        if level == 0:
            proofs[place] = mine
            continue
        run = [digest[level - 1, c] for c in range(FANOUT * place, FANOUT * place + FANOUT) if (level - 1, c) in digest]
        for i in range(len(run)):
            beside = (b"".join(run[:i]), b"".join(run[i + 1:]))
            heapq.heappush(queue, ((1 - level, -(FANOUT * place + i)), [beside, *mine]))
    return proofs


def fold(leaf: bytes, proof: list[tuple[bytes, bytes]]) -> bytes:
    """The root that ``leaf`` and the siblings of ``proof`` lead to."""
    for left, right in proof:
        leaf = _hash([left, leaf, right])
    return leaf


def _write_proof(proof: list[tuple[bytes, bytes]]) -> str:
    return ",".join(f"{a.decode()}|{b.decode()}" for a, b in proof)


def _read_proof(text: str) -> list[tuple[bytes, bytes]]:
    return [tuple(x.encode() for x in level.split("|")) for level in text.split(",")] if text else []


# ------------------------------------------------------------------ trees over tables

def placed(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` (column ``tree``) with ``place`` within the tree by ``order`` and the tree's ``total``."""
    dealt = rows.repartitionByRange(F.col("tree"), *order).sortWithinPartitions("tree", *order)
    mark = F.monotonically_increasing_id()  # partition number, then row number in it
    dealt = materialize(dealt.withColumn("_at", mark), f"{name}-sorted").withColumn("_part", F.shiftright("_at", 33))
    count = dealt.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    tree = Window.partitionBy("tree")
    before = F.sum("_n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    start = count.select("tree", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
                         F.sum("_n").over(tree).alias("total"))
    return dealt.join(start, ["tree", "_part"]).withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def _by_block(nodes: DataFrame, levels: int):
    return nodes.withColumn("block", F.expr(f"place div {FANOUT ** levels}")).groupBy("tree", "block")


def _levels_of(rows: pa.Table, levels: int) -> int | None:
    """None for a block that is a whole tree: it ends at one node."""
    return None if rows["total"][0].as_py() <= FANOUT ** levels else levels


def _hexes(column) -> list[bytes]:
    return [d.hex().encode() for d in column.to_pylist()]


def _top_of_block(levels: int) -> Callable[[pa.Table], pa.Table]:
    def top(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        digest = forward(_hexes(rows["digest"]), _levels_of(rows, levels))
        own = bytes.fromhex(digest[max(digest)].decode())
        total = -(-rows["total"][0].as_py() // FANOUT ** levels)
        return pa.table({"tree": rows["tree"][:1], "place": rows["block"][:1], "total": [total], "digest": pa.array([own], pa.binary())})
    return top


_NODE = "tree string, place bigint, total bigint, digest binary"


def lift(nodes: DataFrame, name: str, levels: int) -> list[DataFrame]:
    """The node tables after 0, 1, 2... blocks of levels; the last has one node (the root) for each tree."""
    rounds = [nodes.select("tree", "place", "total", "digest")]
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        rounds.append(materialize(_by_block(rounds[-1], levels).applyInArrow(_top_of_block(levels), _NODE), f"{name}-nodes"))
        most = -(-most // FANOUT ** levels)
    return rounds


Emit = Callable[[pa.Table, list, pa.Table], pa.Table]


def _sink(emit: Emit, levels: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def down(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        digest = forward(_hexes(rows["digest"]), _levels_of(rows, levels))
        return emit(rows, backward(digest, _read_proof(above["proof"][0].as_py())), above)
    return down


def _proof_rows(rows: pa.Table, proofs: list, _above: pa.Table) -> pa.Table:
    return pa.table({"tree": rows["tree"], "place": rows["place"], "proof": [_write_proof(p) for p in proofs]})


_PROOF = "tree string, place bigint, proof string"


def sink(nodes: DataFrame, above: DataFrame, levels: int, emit: Emit = _proof_rows, schema: str = _PROOF) -> DataFrame:
    """Deliver the proof suffixes ``above`` (tree, place of a block, proof) to the ``nodes`` of the blocks."""
    arriving = above.withColumnRenamed("place", "block").groupBy("tree", "block")
    return _by_block(nodes, levels).cogroup(arriving).applyInArrow(_sink(emit, levels), schema)


def suffixes(rounds: list[DataFrame], roots: DataFrame, name: str, levels: int) -> DataFrame:
    """Proof suffix (tree, place, proof) of every block of the lowest level, from the proofs of the trees' roots."""
    above = roots
    for nodes in reversed(rounds[1:-1]):
        above = materialize(sink(nodes, above, levels), f"{name}-proofs")
    return above


@dataclass(frozen=True)
class Manifest:
    """Leaves with their places, the groups' roots, the root of all, proof suffixes per block of leaves."""

    leaves: DataFrame
    subroots: DataFrame
    root: str | None
    above: DataFrame
    levels: int


def build_manifest(rows: DataFrame, order: list[str], levels: int = BLOCK_LEVELS) -> Manifest:
    """Both sweeps over ``rows`` (group, digest, further narrow columns); leaves ascend by ``order``, then digest.

    Everything that is kept in between is written to the shared folder.
    """
    tie = F.monotonically_increasing_id()  # equal rows are interchangeable; this lets the range partitioner part them
    written = materialize(rows.withColumn("_tie", tie), "merkle-leaves").withColumn("tree", field(F.col("group")))
    leaves = materialize(placed(written, [*map(F.col, order), F.col("digest"), F.col("_tie")], "merkle-leaves"), "merkle-placed")
    lower = lift(leaves, "merkle", levels)
    group = leaves.groupBy("tree").agg(F.first("group").alias("group"))
    subroots = materialize(lower[-1].select("tree", "digest").join(group, "tree"), "merkle-subroots")
    top_rows = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("leaf_tree"), "group", "digest")
    top = materialize(placed(top_rows, [F.col("group")], "merkle-top"), "merkle-top")
    upper = lift(top, "merkle-top", levels)
    root = upper[-1].select(F.lower(F.hex("digest"))).first()
    start = upper[-1].select("tree", "place", F.lit("").alias("proof"))
    if len(upper) > 1:
        start = sink(upper[0], suffixes(upper, start, "merkle-top", levels), levels)
    named = start.join(top.select("tree", "place", "leaf_tree"), ["tree", "place"])
    roots = named.select(F.col("leaf_tree").alias("tree"), F.lit(0).cast("bigint").alias("place"), "proof")
    above = suffixes(lower, materialize(roots, "merkle-root-proofs"), "merkle", levels)
    return Manifest(leaves, subroots, root[0] if root else None, above, levels)


def prove(manifest: Manifest, keep: list[str], tampered: str) -> DataFrame:
    """Every leaf's proof digest, and the root that its ``tampered`` digest (null: its own) folds to.

    Returns ``keep`` columns, leaf, subroot, proof_sha256 and folded_root (lowercase hex).
    """
    above = manifest.above.join(manifest.subroots.select("tree", F.lower(F.hex("digest")).alias("subroot")), "tree")
    kinds = {c: manifest.leaves.schema[c].dataType.simpleString() for c in keep}

    def emit(rows: pa.Table, proofs: list, above: pa.Table) -> pa.Table:
        own = _hexes(rows["digest"])
        other = [None if t is None else t.hex().encode() for t in rows[tampered].to_pylist()]
        proof = [_hash([x for level in p for x in level]).decode() for p in proofs]
        folded = [fold(d if t is None else t, p).decode() for d, t, p in zip(own, other, proofs, strict=True)]
        return pa.table({**{c: rows[c] for c in keep}, "leaf": [d.decode() for d in own], "subroot": [above["subroot"][0].as_py()] * len(own),
                         "proof_sha256": proof, "folded_root": folded})

    schema = ", ".join([*(f"`{c}` {k}" for c, k in kinds.items()), "leaf string, subroot string, proof_sha256 string, folded_root string"])
    needed = manifest.leaves.select(*keep, tampered, "tree", "place", "total", "digest")
    return sink(needed, above, manifest.levels, emit, schema)


def op12_merkle_manifest(documents: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """Leaf, subroot, root, proof digest, folded root and verdict of every document.

    Rows whose id has an even CRC-32 are checked with a text that lost its line feeds.
    """
    fields = lambda text: [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    text = F.col("text").cast("string")
    cut = F.when((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & text.contains("\n"),
                 leaf_digest(*fields(F.replace(text, F.lit("\n"), F.lit("")))))
    rows = documents.select("doc_id", F.col("source").cast("string").alias("group"), leaf_digest(*fields(text)).alias("digest"), cut.alias("tampered"))
    manifest = build_manifest(rows, ["doc_id"], levels)
    root = F.lit(manifest.root).cast("string")
    return prove(manifest, ["doc_id"], "tampered").select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
                                                          (F.col("folded_root") == root).alias("verified"))


def _field_sql(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_CRC_STEP = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
#: CRC-32 of an id's decimal digits, bit by bit.
_CRC_SQL = f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1),
    lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda a, j: {_CRC_STEP})))"""

_LIFT_SQL = f"""SELECT tree, level + 1, place // {FANOUT}, sha256(string_agg(digest, '' ORDER BY place)), (total + {FANOUT - 1}) // {FANOUT}
    FROM {{0}} WHERE total > 1 GROUP BY tree, level, place // {FANOUT}, total"""


def _beside_sql(nodes: str, leaves: str, step: str) -> str:
    """Siblings left and right of each leaf's ancestor on each level below the root."""
    up = f"(l.place // power({FANOUT}, g.level)::BIGINT)"
    return f"""SELECT l.id, {step} AS step, coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place < {up}), '') AS before,
        coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place > {up}), '') AS after
    FROM {leaves} l JOIN (SELECT DISTINCT tree, level FROM {nodes} WHERE total > 1) g USING (tree)
    JOIN {nodes} n ON n.tree = l.tree AND n.level = g.level AND n.place // {FANOUT} = {up} // {FANOUT}
    GROUP BY l.id, {step}"""


OP12_SQL = f"""WITH RECURSIVE leaf AS (
    SELECT row_number() OVER () AS id, doc_id, source, {_field_sql("source")} AS tree, {_leaf_sql("text")} AS leaf,
        CASE WHEN {_CRC_SQL} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS tampered FROM documents),
own AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaf),
node(tree, level, place, digest, total) AS (
    SELECT tree, 0, place, leaf, count(*) OVER (PARTITION BY tree) FROM own UNION ALL {_LIFT_SQL.format("node")}),
sub AS (SELECT n.tree AS source_tree, n.digest, n.level AS height, '' AS tree, row_number() OVER (ORDER BY s.source NULLS FIRST) - 1 AS place
    FROM node n JOIN (SELECT DISTINCT tree, source FROM leaf) s USING (tree) WHERE n.total = 1),
peak(tree, level, place, digest, total) AS (
    SELECT tree, 0, place, digest, count(*) OVER () FROM sub UNION ALL {_LIFT_SQL.format("peak")}),
top AS (SELECT digest AS root FROM peak WHERE total = 1),
high AS (SELECT o.id, s.tree, s.place, s.height FROM own o JOIN sub s ON s.source_tree = o.tree),
beside AS ({_beside_sql("node", "own", "g.level")} UNION ALL {_beside_sql("peak", "high", "l.height + g.level")}),
fold(id, step, digest) AS (
    SELECT id, 0::BIGINT, coalesce(tampered, leaf) FROM leaf UNION ALL
    SELECT f.id, f.step + 1, sha256(b.before || f.digest || b.after) FROM fold f JOIN beside b ON b.id = f.id AND b.step = f.step),
folded AS (SELECT id, arg_max(digest, step) AS folded_root FROM fold GROUP BY id),
proof AS (SELECT id, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256 FROM beside GROUP BY id)
SELECT o.doc_id, o.leaf, s.digest AS subroot, t.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
    f.folded_root, f.folded_root = t.root AS verified
FROM own o JOIN sub s ON s.source_tree = o.tree JOIN folded f USING (id) LEFT JOIN proof p USING (id) CROSS JOIN top t"""

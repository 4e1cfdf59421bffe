"""A Merkle manifest of a dataset by time-forward processing, with a proof for every row.

Every row is a leaf; rows of one tree (a language) ascend by id, every ``FANOUT`` consecutive
nodes become the digest of their concatenated digests, and the roots of all trees are the
leaves of one more tree.

Nodes are labelled by level and index, so children precede their parents.  The upward sweep
visits the labels in order: a priority queue ordered by label delivers the digests of the
children, and the node's own digest is a message to its parent's label.  The reversed sweep
visits the same labels backwards: a node takes the siblings on the way from itself to the root
out of the queue and sends each child that list with the child's own siblings before it.

The queue is external in rounds.  A subtree of ``BLOCK`` nodes is swept in one task, with its
messages in a heap of at most ``BLOCK`` entries; the one message that leaves the subtree is
a row of a table in the shared folder, which is the next round's input.  A round shrinks a tree
``BLOCK`` times, so three rounds serve 10^10 rows, and no task holds more than a subtree,
however large a tree is.  The reversed sweep reads the tables of the rounds backwards.

Positions come from one range partitioning by tree, id and digest: rows are numbered inside
their partition, and one row per partition and tree carries the numbers on.  A further sort
column splits equal rows, so a row repeated any number of times does not meet in one task.

Defined cases: a null field counts as ``-``; rows without a tree name form the first tree, rows
without an id come first in theirs; rows of one id ascend by digest; equal rows are equal
leaves, each with the proof of its own place; a lone leaf is its tree's root with an empty
proof; an empty table has no leaves and no root; texts of any length are hashed whole; other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetstream.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 8
# Levels of a subtree that one task sweeps, and its leaves.
HEIGHT = 4
BLOCK = FANOUT**HEIGHT
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PROOF = "array<struct<left:string,right:string>>"


def leaf(**changed: Column) -> Column:
    """The digest of a row's fields, with some of them replaced."""

    def part(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(part, FIELDS)), 256)


def lower_cased(text: Column) -> Column:
    """The text with A-Z in lower case."""
    return F.translate(text, _UPPER, _LOWER)


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf digest and its siblings lead to."""
    return F.aggregate(proof, digest, lambda d, run: F.sha2(F.concat(run["left"], d, run["right"]), 256))


# --- the two sweeps of one subtree


def _h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels_of(size: int) -> int:
    """Levels above the nodes of a tree of this size that one subtree covers."""
    n = 0
    while size > 1 and n < HEIGHT:
        size, n = -(-size // FANOUT), n + 1
    return n


def upward(digests: list[str], levels: int) -> list[list[str]]:
    """The digests of a subtree by level, each node fed by the queue."""
    nodes = [digests, *([] for _ in range(levels))]
    queue = [(1, i // FANOUT, i, d) for i, d in enumerate(digests)]
    while queue[0][0] <= levels:
        level, index = queue[0][:2]
        children = []
        while queue and queue[0][:2] == (level, index):
            children.append(heapq.heappop(queue)[3])
        digest = _h("".join(children))
        nodes[level].append(digest)
        heapq.heappush(queue, (level + 1, index // FANOUT, index, digest))
    return nodes


def downward(nodes: list[list[str]], suffix: tuple) -> Iterator[tuple[int, tuple]]:
    """Every leaf of a subtree, last first, with its siblings up to the root."""
    queue = [(1 - len(nodes), 0, suffix)]
    while queue:
        level, index, suffix = heapq.heappop(queue)
        level, index = -level, -index
        if level == 0:
            yield index, suffix
            continue
        below = nodes[level - 1]
        first = index * FANOUT
        run = below[first : first + FANOUT]
        for slot in range(len(run)):
            siblings = ("".join(run[:slot]), "".join(run[slot + 1 :]))
            heapq.heappush(queue, (1 - level, -(first + slot), (siblings, *suffix)))


# --- rounds over all subtrees


def _blocks(batches) -> Iterator[tuple[tuple, list[dict]]]:
    """The rows of one subtree at a time; the input is sorted by tree and block."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            k = (row["tree"], row["block"])
            if k != key and rows:
                yield key, rows
                rows = []
            key = k
            rows.append(row)
    if rows:
        yield key, rows


def _climbed(batches):
    found = []

    def flushed():
        columns = zip(*found, strict=True) if found else ([],) * 4
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["tree", "idx", "size", "digest"])

    for (tree, block), rows in _blocks(batches):
        size = rows[0]["size"]
        nodes = upward([r["digest"] for r in rows], levels_of(size))
        found.append((tree, block, -(-size // BLOCK), nodes[-1][0]))
        if len(found) == BLOCK:
            yield flushed()
            found.clear()
    yield flushed()


def _proof_array(proofs: list[tuple]) -> pa.Array:
    offsets, left, right = [0], [], []
    for proof in proofs:
        for a, b in proof:
            left.append(a)
            right.append(b)
        offsets.append(len(left))
    pairs = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["left", "right"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)


def _delivered(batches):
    """Sends every subtree's suffix, its first row, down to the subtree's nodes."""
    for (tree, _), (head, *rows) in _blocks(batches):
        nodes = upward([r["digest"] for r in rows], levels_of(rows[0]["size"]))
        suffix = tuple((run["left"], run["right"]) for run in head["proof"])
        places, proofs = zip(*downward(nodes, suffix), strict=True)
        reached = [rows[i] for i in places]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([tree] * len(rows), pa.string()),
                pa.array([r["idx"] for r in reached], pa.int64()),
                pa.array([r["digest"] for r in reached], pa.string()),
                pa.array([r["carried"] for r in reached], pa.binary()),
                pa.array([head["subroot"]] * len(rows), pa.string()),
                _proof_array(proofs),
            ],
            ["tree", "idx", "digest", "carried", "subroot", "proof"],
        )


def _dealt(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of every round, from ``tree, idx, size, digest`` to one root per tree."""
    size = nodes.agg(F.max("size")).first()[0] or 0
    rounds = [nodes]
    while True:
        blocks = rounds[-1].select("tree", "idx", "size", "digest", F.expr(f"idx div {BLOCK}").alias("block"))
        risen = _dealt(blocks).mapInArrow(_climbed, "tree string, idx bigint, size bigint, digest string")
        rounds.append(written(risen, "merkle-nodes"))
        if size <= BLOCK:
            return rounds
        size = -(-size // BLOCK)


def _reversed(rounds: list[DataFrame], heads: DataFrame) -> DataFrame:
    """Proofs of the first round's nodes; ``heads`` has ``tree, subroot, proof`` of the roots."""
    heads = heads.select("tree", F.lit(0).cast("bigint").alias("block"), "subroot", "proof")
    for nodes in reversed(rounds[:-1]):
        carried = F.col("carried") if "carried" in nodes.columns else F.lit(None).cast("binary")
        below = nodes.select(
            "tree", F.expr(f"idx div {BLOCK}").alias("block"), "idx", "size", "digest", carried.alias("carried")
        )
        messages = heads.withColumn("idx", F.lit(-1).cast("bigint"))
        down = _dealt(below.unionByName(messages, allowMissingColumns=True)).mapInArrow(
            _delivered, f"tree string, idx bigint, digest string, carried binary, subroot string, proof {_PROOF}"
        )
        if nodes is rounds[0]:
            return down
        heads = written(down.select("tree", F.col("idx").alias("block"), "subroot", "proof"), "merkle-proofs")
    raise ValueError("no rounds")


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``idx``, the position in the row's ``tree``, and the tree's ``size``."""
    salted = rows.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    keys = ["tree", *order, "_salt"]
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = written(
        salted.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(*rows.columns, F.spark_partition_id().alias("_part"), row.alias("_row")),
        "merkle-order",
    )
    parts = numbered.groupBy("tree", "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    tree = Window.partitionBy("tree")
    before = F.sum("_n").over(tree.orderBy("_part")) - F.col("_n")
    bases = parts.select(
        "tree", "_part", (before - F.col("_first")).alias("_base"), F.sum("_n").over(tree).alias("size")
    )
    return numbered.join(bases, ["tree", "_part"]).select(
        *rows.columns, (F.col("_base") + F.col("_row")).alias("idx"), "size"
    )


def manifest(docs: DataFrame, claim: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, claim, proof`` of every row.

    ``claim`` is a digest to be checked against the root, the row's own leaf by default;
    ``proof`` lists the digests left and right of the path, level by level up to the root.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    own = docs.select(tree.alias("tree"), "doc_id", leaf().alias("digest"), (claim if claim is not None else leaf()).alias("claim"))
    hashed = written(own, "merkle-leaves")
    # What a leaf carries through the sweeps, in one column of a fixed type.
    kept = F.to_json(F.struct("doc_id", "claim")).cast("binary")
    nodes = placed(hashed, ["doc_id", "digest"]).select("tree", "idx", "size", "digest", kept.alias("carried"))
    rounds = _rounds(written(nodes, "merkle-leaves"))

    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    top = written(placed(subroots, ["name"]), "merkle-roots")
    top_rounds = _rounds(top)
    root = top_rounds[-1].select("digest").first()
    nothing = F.array().cast(_PROOF).alias("proof")
    ends = top_rounds[-1].select("tree", F.col("digest").alias("subroot"), nothing)
    above = _reversed(top_rounds, ends).select("idx", F.col("digest").alias("subroot"), "proof")
    heads = above.join(top.select("idx", F.col("name").alias("tree")), "idx").select("tree", "subroot", "proof")

    fields = F.from_json(
        F.col("carried").cast("string"), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, claim string"
    )
    return _reversed(rounds, heads).select(
        fields["doc_id"].alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root["digest"] if root else None).cast("string").alias("root"),
        fields["claim"].alias("claim"),
        "proof",
    )


def report(docs: DataFrame, tampered: Column) -> DataFrame:
    """Verifies every row against the root, with its text changed where ``tampered`` holds."""
    forged = F.when(tampered, leaf(text=lower_cased(F.col("text")))).otherwise(leaf())
    siblings = F.array_join(F.flatten(F.transform("proof", lambda run: F.array(run["left"], run["right"]))), "")
    found = manifest(docs, forged).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded(F.col("claim"), F.col("proof")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))

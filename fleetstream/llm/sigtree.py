"""Exact Jaccard join of shingle sets with signature trees, and its components.

Documents with equal sets are one class.  Two linked sets share at least ``k`` shingles among
the first ``n - ceil(t n) + k`` of each in any common order; the order is by digest, with
shingles that a bounded sketch found frequent last, and ``k`` grows with the size, so that a
passage in common is not enough.  The classes that share such a shingle form a cluster, named
after its least class, so the clusters of a group of near copies coincide; classes with fewer
shared shingles than any partner would give them are dropped.

In a cluster the classes are leaves of a signature tree: leaves in order of size, nodes
with the OR of their token bitmaps, the range of sizes and the largest number of tokens
hidden by equal bits.  Two trees are traversed together, depth first and a bounded number of
pairs at a time: a pair of nodes is dropped if no pair of sets below it can overlap enough, or
if all sets below both are connected already.  Leaf pairs that remain are compared exactly,
unless their classes are connected already; what leaves the task is one star per connected
part, never a pair list.  Clusters with more than ``CLUSTER_TOKENS`` shingles or
``CLUSTER_MEMBERS`` classes are cut into blocks, and every pair of blocks is joined.

Components come from alternating large-star and small-star steps over the stars, each
step a grouped minimum, with the lineage cut after every round.

Defined cases: texts that are null, empty or without words have an empty set, which is
linked with nothing; texts with fewer than five words are one shingle; a class whose rows
all lack an id has a null component; equal rows are in one class; other columns are
ignored; an empty table gives an empty result; texts of any length are taken whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from fleetstream.llm.common import row_key, words, written

SHINGLE = 5
PERCENT = 80
# A prefix is longer by one in so many shingles, and as many more have to be shared.
SHARED_PART = 10
CLUSTER_TOKENS = 1_500_000
CLUSTER_MEMBERS = 8192
FANOUT = 16
# Pairs of nodes, and of sets, that a traversal takes at a time.
NODE_PAIRS, LEAF_PAIRS = 256, 4096
# Sketch of shingle counts: buckets, the most frequent ones that a task reports, and the
# most frequent ones of all that are ordered last.
BUCKETS, REPORTED, FREQUENT = 1 << 20, 2048, 4096
WORDS_KNOWN = 500_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_TOP = np.uint64(1 << 63)


class _WordDigests(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxh3_64_intdigest(word)
        return value


_WORDS = _WordDigests()


def shingles(text: bytes | None) -> np.ndarray:
    """The sorted digests of a text's distinct shingles."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxh3_64_intdigest(b" ".join(words), seed=1)], dtype=np.uint64)
    if len(_WORDS) > WORDS_KNOWN:
        _WORDS.clear()
    w = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    n = len(w) - SHINGLE + 1
    h = w[:n] * _C[0]
    for i in range(1, SHINGLE):
        h ^= h >> np.uint64(29)
        h += w[i : i + n]
        h *= _C[i]
    h ^= h >> np.uint64(32)
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if n > 1 else h


def class_of(found: np.ndarray) -> int:
    """A 64-bit digest of a set, as a signed number."""
    return xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def asked(n):
    """Shingles that a set of size ``n`` has to share in its prefix, for the prefix's length."""
    return 1 + n // SHARED_PART


def prefix_size(n: int) -> int:
    return n - -(-PERCENT * n // 100) + asked(n)


def least_shared(n: Column) -> Column:
    """Shingles that a set surely shares with a partner: what the smallest partner is asked."""
    return 1 + F.floor(F.ceil(n * PERCENT / 100) / SHARED_PART)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(a) + len(b)
    common = both - len(np.unique(np.concatenate([a, b])))
    return 100 * common >= PERCENT * (both - common)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(44)).astype(np.int64)


# --- sets and clusters


def _sets(batches):
    """A row per document, and the task's most frequent shingle buckets."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    names = ["doc_id", "key", "size", "class", "bucket", "count"]
    kind = None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        found = [shingles(t) for t in batch.column("text").to_pylist()]
        if found:
            counts += np.bincount(_bucket(np.concatenate(found)), minlength=BUCKETS)
        n = len(found)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("key"),
                pa.array([len(s) for s in found], pa.int64()),
                pa.array([class_of(s) if len(s) else None for s in found], pa.int64()),
                pa.nulls(n, pa.int32()),
                pa.nulls(n, pa.int64()),
            ],
            names,
        )
    top = np.argsort(counts)[-REPORTED:]
    top = top[counts[top] > 1]
    if len(top):
        n = len(top)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, kind), *(pa.nulls(n, pa.int64()) for _ in range(3)), pa.array(top, pa.int32()), pa.array(counts[top])],
            names,
        )


def _prefixes(frequent):
    """``token, class, size`` for the first shingles of every class, once per task."""

    def run(batches):
        last = np.zeros(BUCKETS, dtype=bool)
        last[frequent.value] = True
        seen: set[int] = set()
        for batch in batches:
            tokens, classes, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text)
                if not len(found) or (c := class_of(found)) in seen:
                    continue
                seen.add(c)
                k = prefix_size(len(found))
                rest = found & ~_TOP
                order = np.where(last[_bucket(found)], rest | _TOP, rest)
                if k < len(order):
                    order = np.partition(order, k - 1)[:k]
                k = len(order)
                tokens.append(order)
                classes.append(np.full(k, c, dtype=np.int64))
                sizes.append(np.full(k, len(found), dtype=np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens).view(np.int64)),
                        pa.array(np.concatenate(classes)),
                        pa.array(np.concatenate(sizes)),
                    ],
                    ["token", "class", "size"],
                )

    return run


def _clusters(batches):
    """From rows sorted by token, size and class to ``cluster, class, size, shared``.

    ``shared`` is the number of shingles by which the class is in the cluster.
    A token's classes are cut where one is too small for the next larger one.  Rows of a
    token that goes on in the next batch are carried.
    """
    held = None

    def made(token, cls, size):
        size = size.astype(np.int64)
        if not len(token):
            return None
        new = np.concatenate(
            [[True], (token[1:] != token[:-1]) | (100 * size[:-1] < PERCENT * size[1:])]
        )
        group = np.cumsum(new) - 1
        start = np.flatnonzero(new)
        least = np.minimum.reduceat(cls, start)[group]
        most = np.maximum.reduceat(cls, start)[group]
        keep = least != most
        # A class that several tasks sent is there more than once for a token.
        keep &= np.concatenate([[True], (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])])
        rows, shared = np.unique(
            np.stack([least[keep], cls[keep], size[keep]], axis=1), axis=0, return_counts=True
        )
        return pa.RecordBatch.from_arrays(
            [*(pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)), pa.array(shared.astype(np.int64))],
            ["cluster", "class", "size", "shared"],
        )

    for batch in batches:
        now = [batch.column(c).to_numpy() for c in ("token", "class", "size")]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now, strict=True)]
        cut = int(np.searchsorted(now[0], now[0][-1], side="left")) if len(now[0]) else 0
        held = [x[cut:] for x in now]
        if (out := made(*(x[:cut] for x in now))) is not None and out.num_rows:
            yield out
    if held is not None and (out := made(*held)) is not None and out.num_rows:
        yield out


# --- the signature tree


class SignatureTree:
    """Levels of nodes over sets in order of size; level 0 has the sets themselves."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        bits = 1 << int(np.ceil(np.log2(max(256, min(4 * int(sizes.max()), (1 << 28) // max(len(sets), 64), 1 << 16)))))
        maps = np.zeros((len(sets), bits // 64), dtype=np.uint64)
        for row, s in zip(maps, sets, strict=True):
            at = s & np.uint64(bits - 1)
            np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        hidden = sizes - np.bitwise_count(maps).sum(axis=1).astype(np.int64)
        self.levels = [(maps, sizes, sizes, hidden)]
        while len(self.levels[-1][0]) > FANOUT:
            maps, low, high, hidden = self.levels[-1]
            start = np.arange(0, len(maps), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, start, axis=0),
                    np.minimum.reduceat(low, start),
                    np.maximum.reduceat(high, start),
                    np.maximum.reduceat(hidden, start),
                )
            )

    def possible(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether sets below the nodes of each pair can overlap enough."""
        maps, low, high, hidden = self.levels[level]
        can = (100 * high[a] >= PERCENT * low[b]) & (100 * high[b] >= PERCENT * low[a])
        at = np.flatnonzero(can)
        for i in range(0, len(at), 4096):
            part = at[i : i + 4096]
            x, y = a[part], b[part]
            shared = np.bitwise_count(maps[x] & maps[y]).sum(axis=1).astype(np.int64)
            most = np.minimum(shared + np.minimum(hidden[x], hidden[y]), np.minimum(high[x], high[y]))
            # overlap >= t (union) is overlap >= t / (1 + t) of both sizes together
            can[part] = (100 + PERCENT) * most >= PERCENT * (low[x] + low[y])
        return can

    def parts(self, join: np.ndarray | None = None) -> np.ndarray:
        """The connected part of every set: the least position in it.

        With ``join`` (a side per set, 0 or 1) only pairs of different sides are compared.
        """
        part = np.arange(len(self.sets))
        top = len(self.levels) - 1
        a, b = np.triu_indices(len(self.levels[top][0]))
        # Depth first, a bounded chunk at a time; pairs of a node with itself come first, so
        # that most of what is connected is known when other pairs are reached.
        todo = self._chunks(top, a, b)
        uniform = self._uniform(part)
        while todo:
            level, a, b = todo.pop()
            if uniform is None:
                uniform = self._uniform(part)
            one = uniform[level]
            apart = (one[a] != one[b]) | (one[a] < 0)
            if not level:
                apart &= a != b
                if join is not None:
                    apart &= join[a] != join[b]
            a, b = a[apart], b[apart]
            good = self.possible(level, a, b)
            a, b = a[good], b[good]
            if level:
                todo += self._chunks(level - 1, *self._below(level - 1, a, b))
                continue
            for p, q in zip(a.tolist(), b.tolist(), strict=True):
                if part[p] != part[q] and linked(self.sets[p], self.sets[q]):
                    low, high = sorted((part[p], part[q]))
                    part[part == high] = low
                    uniform = None
        return part

    def _uniform(self, part: np.ndarray) -> list[np.ndarray]:
        """Per level and node the part that all sets below it are in, or -1."""
        low = high = part
        out = [part]
        for _ in self.levels[1:]:
            start = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, start), np.maximum.reduceat(high, start)
            out.append(np.where(low == high, low, -1))
        return out

    def _chunks(self, level: int, a: np.ndarray, b: np.ndarray) -> list:
        """The pairs as chunks, the one to take first last."""
        order = np.argsort(b - a, kind="stable")
        a, b = a[order], b[order]
        size = LEAF_PAIRS if not level else NODE_PAIRS
        return [(level, a[i : i + size], b[i : i + size]) for i in range(0, len(a), size)][::-1]

    def _below(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of children of pairs of nodes."""
        n = len(self.levels[level][0])
        step = np.arange(FANOUT)
        x = (a[:, None, None] * FANOUT + step[None, :, None] + 0 * step[None, None, :]).ravel()
        y = (b[:, None, None] * FANOUT + 0 * step[None, :, None] + step[None, None, :]).ravel()
        good = (x < n) & (y < n) & (x <= y)
        return x[good], y[good]


def _joined(batches):
    """Rows of clusters (or pairs of blocks) to stars ``root, class``."""

    def stars(rows: dict):
        if len(rows) < 2:
            return []
        ranked = sorted(((len(s), int(s[0]), c, s, side) for c, (s, side) in rows.items()), key=lambda x: x[:3])
        sides = np.array([r[4] for r in ranked])
        tree = SignatureTree([r[3] for r in ranked])
        part = tree.parts(sides if sides.any() else None)
        least: dict[int, int] = {}
        for p, r in zip(part.tolist(), ranked, strict=True):
            least[p] = min(least.get(p, r[2]), r[2])
        return [(least[p], r[2]) for p, r in zip(part.tolist(), ranked, strict=True) if least[p] != r[2]]

    rows: dict = {}
    key = None
    for batch in batches:
        out = []
        for *k, c, text, side in zip(
            *(batch.column(x).to_pylist() for x in ("cluster", "i", "j", "class", "text", "side")), strict=True
        ):
            if k != key:
                out += stars(rows)
                rows, key = {}, k
            if c not in rows:
                rows[c] = (shingles(text), side)
        yield _star_batch(out)
    yield _star_batch(stars(rows))


def _star_batch(rows: list) -> pa.RecordBatch:
    a, b = zip(*rows, strict=True) if rows else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["root", "class"])


# --- components


def _fingerprint(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    digest = F.xxhash64("v", "u")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(digest), F.bit_xor(F.xxhash64(digest))).first())


def components(links: DataFrame) -> DataFrame:
    """``class, part`` for every end of the links ``a, b``: the least class it is connected to."""
    edges = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u <> v").distinct()
    edges = written(edges, "links")
    state = _fingerprint(edges)
    while True:
        # Large star: every larger neighbour is linked to the least one.
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = (
            both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        )
        # Small star: the smaller neighbours and the vertex itself are linked to the least.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        stepped = (
            large.join(low, "v")
            .where("u <> m")
            .select(F.col("u").alias("v"), F.col("m").alias("u"))
            .unionByName(low.select("v", F.col("m").alias("u")))
            .distinct()
        )
        edges, before = written(stepped, "links"), state
        state = _fingerprint(edges)
        if state == before:
            break
    ends = edges.select(F.col("v").alias("class"), F.col("u").alias("part"))
    return ends.unionByName(ends.select(F.col("part").alias("class"), "part").distinct())


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per document its row key, class and size, and the stars that connect classes."""
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(
        "doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("text").cast("binary").alias("text")
    )
    measured = written(
        texts.mapInArrow(
            _sets, f"doc_id {id_type}, key bigint, size bigint, class bigint, bucket int, count bigint"
        ),
        "sets",
    )
    sets = measured.where("bucket is null").select("doc_id", "key", "size", "class")
    top = (
        measured.where("bucket is not null")
        .groupBy("bucket")
        .agg(F.sum("count").alias("n"))
        .orderBy(F.desc("n"), "bucket")
        .limit(FREQUENT)
    )
    frequent = spark.sparkContext.broadcast(np.array([r["bucket"] for r in top.collect()], dtype=np.int64))
    prefixes = texts.mapInArrow(_prefixes(frequent), "token bigint, class bigint, size int")
    dealt = prefixes.repartition("token").sortWithinPartitions("token", "size", "class")
    shared = written(
        dealt.mapInArrow(_clusters, "cluster bigint, class bigint, size bigint, shared bigint")
        .groupBy("cluster", "class", "size")
        .agg(F.sum("shared").alias("shared")),
        "clusters",
    )
    enough = (
        shared.groupBy("class", "size")
        .agg(F.sum("shared").alias("shared"))
        .where(F.col("shared") >= least_shared(F.col("size")))
    )
    clusters = shared.drop("shared").join(enough.select("class"), "class", "left_semi")
    # Large clusters are cut into blocks; a class goes to every pair that has its block.
    blocks = (
        clusters.groupBy("cluster")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.greatest(
                F.ceil(F.sum("size") / CLUSTER_TOKENS), F.ceil(F.count(F.lit(1)) / CLUSTER_MEMBERS)
            ).cast("int").alias("n"),
        )
        .where("members > 1")
        .drop("members")
    )
    placed = clusters.join(blocks, "cluster")
    own = F.pmod(F.xxhash64("class"), F.col("n")).cast("int")
    spread = placed.select("cluster", "class", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("x"))
    wanted = spread.select(
        "cluster",
        "class",
        F.least("own", "x").alias("i"),
        F.greatest("own", "x").alias("j"),
        # In a pair of different blocks only classes of different ones are compared.
        F.when(F.col("own") <= F.col("x"), F.lit(0)).otherwise(F.lit(1)).alias("side"),
    )
    with_class = texts.mapInArrow(_with_class, "class bigint, text binary")
    cluster_rows = wanted.join(with_class, "class")
    ready = cluster_rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    stars = ready.mapInArrow(_joined, "root bigint, class bigint")
    return sets, written(stars.select(F.col("root").alias("a"), F.col("class").alias("b")), "stars")


def _with_class(batches):
    """The text of every class, once per task."""
    seen: set[int] = set()
    for batch in batches:
        out = []
        for text in batch.column("text").to_pylist():
            found = shingles(text)
            if len(found) and (c := class_of(found)) not in seen:
                seen.add(c)
                out.append((c, text))
        a, b = zip(*out, strict=True) if out else ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.binary())], ["class", "text"])


def labelled(docs: DataFrame) -> DataFrame:
    """``doc_id, key, size, part``: the part is the least class of the component, or null."""
    sets, stars = classes(docs)
    parts = components(stars)
    return sets.join(parts, "class", "left").select(
        "doc_id", "key", "size", F.coalesce("part", "class").alias("part")
    )


def joined(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    rows = labelled(docs)
    least = rows.where("part is not null").groupBy("part").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "part", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("part").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of every component: the least id, rows without one last, one of equal rows.

    Rows without words are linked with nothing and all stay.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    first = (
        labelled(docs)
        .where("part is not null")
        .groupBy("part")
        .agg(F.min(order).alias("first"))
        .select(F.col("first.key").alias("key"))
    )
    rows = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), F.struct("*").alias("_row"))
    chosen = rows.join(first, "key", "left_semi").dropDuplicates(["key"]).select("_row.*")
    return chosen.unionByName(docs.where(F.size(words(F.col("text"))) == 0))

"""SimHash near-duplicates joined on Golay-code keys, and their components.

A fingerprint of 64 bits is cut into three segments of at most 22 bits, each a word of the
perfect (23, 12) Golay code with its missing bits zero.  Every word decodes to the one
codeword within distance three.  The near codewords of a segment are those that it or the
segment with one bit flipped decodes to, one to six of them.  Two segments that differ in one
bit: what the first decodes to is near the second.  In two bits: the segment between them
decodes to a codeword near both.

At most four errors fall on three segments in one of two ways:

* a segment is free of errors, and one of the others has at most two: both fingerprints have
  the key of that segment's bits with a near codeword of the other;
* every segment has one, so at least two have exactly one: both have a key of what one
  segment decodes to and a near codeword of the other.

Fingerprints with a common key meet in one task, where all are compared exactly: small keys
by shifting the sorted rows, larger ones by a search over what is not connected yet.  What
leaves the task is a link per connection found, not a pair list.

Keys of more than ``CROWDED`` fingerprints are not compared.  Their fingerprints are keyed
anew: four errors leave four of eight bytes alone, so each choice of four bytes is a key; and
where those are crowded too, each choice of four of the eight remaining half-bytes beside them.
That leaves 16 free bits, so a key has at most 65 536 fingerprints.  No link is lost.

Only different fingerprints are keyed, so any number of copies counts once; documents get
their component through a checked broadcast of the fingerprints that many documents share and
a shuffle for the others.

Defined cases: texts that are null, empty or without words have the fingerprint zero and are
linked like any other; fewer than four words are one shingle; a component whose rows all lack
an id is null; equal rows are in one component; other columns are ignored; an empty table
gives an empty result; texts of any length are taken whole, ``SHINGLES`` shingles at a time.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from fleetstream.llm.common import written
from fleetstream.llm.sigtree import components
from fleetstream.operators.lookup import Index

WORDS, SEED = 4, 42
MOST_ERRORS = 4
# First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
SHINGLES = 1 << 16
CROWDED = 4096
# Up to this size the members of a key are compared by shifting.
SMALL = 16
_GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# --- fingerprints


def fingerprint(text: bytes | None) -> int:
    """The majority of the bits of all shingle digests."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(len(words) - WORDS + 1, 1)
    first = [0, *(ends[: n - 1] + 1).tolist()]
    last = ends[min(WORDS, len(words)) - 1 :].tolist()
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, SHINGLES):
        parts = zip(first[start : start + SHINGLES], last[start : start + SHINGLES], strict=True)
        h = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in parts], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def _fingerprints(batches):
    for batch in batches:
        found = [fingerprint(t) for t in batch.column("text").to_pylist()]
        prints = np.array(found, dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], ["doc_id", "print"])


# --- the Golay code


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= _GENERATOR << (bit - 11)
    return word


def _decoder() -> tuple[np.ndarray, np.ndarray]:
    """The remainder that each bit adds, and the errors that each remainder stands for."""
    bits = np.array([_remainder(1 << i) for i in range(23)], dtype=np.int64)
    errors = np.zeros(1 << 11, dtype=np.int64)
    for weight in range(1, 4):
        for places in combinations(range(23), weight):
            errors[np.bitwise_xor.reduce(bits[list(places)])] = sum(1 << p for p in places)
    return bits, errors


_BITS, _ERRORS = _decoder()


def decoded(words: np.ndarray) -> np.ndarray:
    """The index of the codeword within distance three of each word of 23 bits."""
    rest = np.zeros_like(words)
    for i, remainder in enumerate(_BITS.tolist()):
        rest ^= (words >> i & 1) * remainder
    return (words ^ _ERRORS[rest]) >> 11


def near_codewords(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A row per word: the codewords that it and its neighbours decode to, and which are new."""
    flips = np.array([0, *(1 << i for i in range(width))], dtype=np.int64)
    found = np.sort(decoded((words[:, None] ^ flips).ravel()).reshape(len(words), -1), axis=1)
    new = np.ones_like(found, dtype=bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    return found, new


# --- keys


def _key_batch(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(prints.view(np.int64))], ["key", "print"])


def _fuzzy_keys(batches):
    """Keys of the segments: a tag, bits or codeword of one, near codeword of another."""
    for batch in batches:
        prints = batch.column("print").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        if not len(prints):
            continue
        parts = [(prints >> np.uint64(at) & np.uint64((1 << w) - 1)).astype(np.int64) for at, w in SEGMENTS]
        center = [decoded(p) for p in parts]
        near = [near_codewords(p, w) for p, (_, w) in zip(parts, SEGMENTS, strict=True)]

        def keyed(tag: int, one: np.ndarray, codewords: tuple, flip: bool = False):
            found, new = codewords
            row, column = np.nonzero(new)
            a, b = (found[row, column], one[row]) if flip else (one[row], found[row, column])
            return np.int64(tag << 44) | a << 12 | b, row

        rows, keys = [], []
        for i in range(3):
            for j in range(3):
                if i == j:
                    continue
                key, row = keyed(3 * i + j, parts[i], near[j])
                keys.append(key)
                rows.append(row)
        for i, j in combinations(range(3), 2):
            tag = 16 + 3 * i + j
            own, own_row = keyed(tag, center[i], near[j])
            other, other_row = keyed(tag, center[j], near[i], flip=True)
            both = np.unique(np.stack([np.concatenate([own_row, other_row]), np.concatenate([own, other])]), axis=1)
            rows.append(both[0])
            keys.append(both[1])
        yield _key_batch(np.concatenate(keys), prints[np.concatenate(rows)])


def _mixed(values: np.ndarray, tag: np.ndarray | int) -> np.ndarray:
    """A digest; fingerprints that meet by chance are compared like all others."""
    h = (values ^ (np.uint64(0x9E3779B97F4A7C15) * np.asarray(tag, dtype=np.uint64))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h * np.uint64(0xD6E8FEB86659FD93)


def _masks(parts: list[int]) -> list[int]:
    return [sum(chosen) for chosen in combinations(parts, len(parts) - MOST_ERRORS)]


BYTE_MASKS = _masks([0xFF << s for s in range(0, 64, 8)])


def _nibble_masks(kept: int) -> list[int]:
    """Four bytes with each choice of four of the other half-bytes."""
    return [kept | m for m in _masks([0xF << s for s in range(0, 64, 4) if not kept >> s & 1])]


def _byte_keys(batches):
    """Keys of four whole bytes, with the number of the choice."""
    for batch in batches:
        prints = batch.column("print").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        for i, mask in enumerate(BYTE_MASKS):
            made = _key_batch(_mixed(prints & np.uint64(mask), i + 1), prints)
            yield made.append_column("choice", pa.array(np.full(len(prints), i, dtype=np.int32)))


def _nibble_keys(batches):
    """Keys of four bytes and four half-bytes, for choices of bytes that are crowded."""
    for batch in batches:
        prints = batch.column("print").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        choices = batch.column("choice").to_numpy(zero_copy_only=False)
        for i in np.unique(choices).tolist():
            own = prints[choices == i]
            for j, mask in enumerate(_nibble_masks(BYTE_MASKS[i])):
                yield _key_batch(_mixed(own & np.uint64(mask), 1000 * (i + 1) + j), own)


# --- comparison


def _linked_large(members: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is connected: a search over what has not been reached."""
    links, left = [], members
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            one = frontier.pop()
            near = np.bitwise_count(left ^ one) <= MOST_ERRORS
            if near.any():
                reached = left[near]
                links += [(int(one), int(r)) for r in reached]
                frontier.extend(reached)
                left = left[~near]
    return links


def _linked(batches):
    """Links between the fingerprints of every key; the input is sorted by key and fingerprint."""
    rest_k = np.empty(0, dtype=np.int64)
    rest_p = np.empty(0, dtype=np.uint64)

    def links(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        a, b = [], []
        if len(keys):
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(starts, len(keys)))
            for at in np.flatnonzero(sizes > SMALL).tolist():
                found = _linked_large(np.unique(prints[starts[at] : starts[at] + sizes[at]]))
                a += [x for x, _ in found]
                b += [y for _, y in found]
            small = np.repeat(sizes <= SMALL, sizes)
            k, p = keys[small], prints[small]
            for step in range(1, min(SMALL, len(k))):
                same = k[step:] == k[:-step]
                if not same.any():
                    break
                near = same & (np.bitwise_count(p[step:] ^ p[:-step]) <= MOST_ERRORS)
                a += p[:-step][near].tolist()
                b += p[step:][near].tolist()
        made = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (a, b)]
        return pa.RecordBatch.from_arrays(made, ["a", "b"])

    for batch in batches:
        keys = np.concatenate([rest_k, batch.column("key").to_numpy(zero_copy_only=False)])
        prints = np.concatenate([rest_p, batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(keys):
            continue
        whole = int(np.searchsorted(keys, keys[-1]))
        yield links(keys[:whole], prints[:whole])
        rest_k, rest_p = keys[whole:], prints[whole:]
    yield links(rest_k, rest_p)


def _compared(keys: DataFrame) -> DataFrame:
    dealt = keys.select("key", "print").repartition("key").sortWithinPartitions("key", "print")
    return dealt.mapInArrow(_linked, "a bigint, b bigint")


def _split(keys: DataFrame, crowded: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows of keys that few fingerprints share, and the others."""
    many = written(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowded).select("key"), name)
    return keys.join(many, "key", "left_anti"), keys.join(many, "key", "left_semi")


def links(prints: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Links ``a, b`` that connect all different ``print`` at most four bits apart."""
    keys = written(prints.select("print").mapInArrow(_fuzzy_keys, "key bigint, print bigint"), "golay-keys")
    few, many = _split(keys, crowded, "golay-crowded")
    byte_keys = written(
        many.select("print").distinct().mapInArrow(_byte_keys, "key bigint, print bigint, choice int"), "golay-bytes"
    )
    few_bytes, many_bytes = _split(byte_keys, crowded, "golay-crowded")
    nibble_keys = many_bytes.select("print", "choice").distinct().mapInArrow(_nibble_keys, "key bigint, print bigint")
    found = _compared(few).unionByName(_compared(few_bytes)).unionByName(_compared(nibble_keys))
    return written(found, "golay-links")


def grouped(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = written(texts.mapInArrow(_fingerprints, f"doc_id {id_type}, print bigint"), "golay-prints")
    prints = written(rows.groupBy("print").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")), "golay-distinct")
    parts = components(links(prints, crowded)).withColumnRenamed("class", "print")
    placed = prints.join(parts, "print", "left").withColumn("part", F.coalesce("part", "print"))
    least = placed.groupBy("part").agg(F.min("least").alias("component_id"))
    named = Index.of(placed.join(least, "part").select("print", "n", "component_id"), "print", "n")
    return named.join(rows, ["component_id"]).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )

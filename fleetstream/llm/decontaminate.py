"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded slice of the texts of a task.  Its words become symbols: those of the
benchmark's vocabulary each their own, all others one separator, and runs of vocabulary
words that are too short to hold a phrase are left out.  Over the rest a suffix array
gives the Burrows-Wheeler transform, kept as a wavelet matrix; every phrase is searched
backwards through its ranks, all phrases at a time; occurrences are located by walking to
the next sampled suffix position.  The words found are merged into removal spans.

The benchmark is the query set.  It is sent to the tasks in blocks of at most
``BLOCK_BYTES`` of item text (one item, if longer, is a block of its own); each block is
one pass over the documents, without a shuffle.

Defined cases: null and empty texts have no words and no hits; null ids are kept; repeated
rows are each judged; items without words are ignored, items with equal windows are both
named; an empty benchmark hits nothing; an empty table gives an empty result; long texts
are turned into symbols piece by piece and indexed whole.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetstream.llm.common import packed

WINDOW = 10
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 6 << 20
SAMPLE = 8
END, OTHER, FIRST = 0, 1, 2

# What words are made of, and the folding of A-Z.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def word_list(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


# --- the index


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the prefix they are sorted by."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(np.diff(symbols[order]) != 0)])
    step = 1
    while rank[order[-1]] < n - 1:
        second = np.zeros(n, dtype=np.int64)
        second[:-step] = rank[step:] + 1
        # Suffixes that share their prefix with no other keep their place.
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        step *= 2
    return order


class WaveletMatrix:
    """Ranks of all symbols of a sequence, by one bit plane per level."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = []
        self.bits = range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1)
        rest = symbols
        for bit in self.bits:
            plane = (rest >> bit) & 1
            ones = np.concatenate([[0], np.cumsum(plane, dtype=np.int32)]).astype(np.int32)
            zeros = len(rest) - int(ones[-1])
            self.levels.append((ones, zeros))
            rest = np.concatenate([rest[plane == 0], rest[plane == 1]])

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` of the sequence stands among the symbol on the last level."""
        for bit, (ones, zeros) in zip(self.bits, self.levels, strict=True):
            up = ones[at]
            at = np.where((symbol >> bit) & 1, zeros + up, at - up)
        return at

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at some positions, and where they stand on the last level."""
        symbol = np.zeros(len(at), dtype=np.int64)
        for ones, zeros in self.levels:
            up = ones[at]
            one = ones[at + 1] - up
            symbol = symbol << 1 | one
            at = np.where(one, zeros + up, at - up)
        return symbol, at


class FmIndex:
    """Backward search and locating in one sequence that ends with the symbol ``END``."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        order = suffix_array(symbols)
        self.size = len(symbols)
        self.matrix = WaveletMatrix(symbols[order - 1].astype(np.int64), n_symbols)
        counts = np.bincount(symbols, minlength=n_symbols)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])
        every = np.arange(n_symbols)
        self.origin = self.matrix.place(every, np.zeros(n_symbols, dtype=np.int64))
        self.sampled = np.concatenate([[0], np.cumsum(order % SAMPLE == 0)])
        self.samples = order[order % SAMPLE == 0]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last-plus-one row of the suffixes that start with each phrase."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.size, dtype=np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column]
            shift = self.before[symbol] - self.origin[symbol]
            low[alive] = self.matrix.place(symbol, low[alive]) + shift
            high[alive] = self.matrix.place(symbol, high[alive]) + shift
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        dead = np.ones(len(phrases), dtype=bool)
        dead[alive] = False
        high[dead] = low[dead]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes at some rows."""
        found = np.empty(len(rows), dtype=np.int64)
        todo, at, walked = np.arange(len(rows)), rows, 0
        while len(todo):
            here = self.sampled[at + 1] > self.sampled[at]
            found[todo[here]] = self.samples[self.sampled[at[here]]] + walked
            todo, at = todo[~here], at[~here]
            symbol, place = self.matrix.access(at)
            at = self.before[symbol] + place - self.origin[symbol]
            walked += 1
        return found


# --- the query set


class Phrases:
    """Distinct windows of a block of items as symbols, by length."""

    def __init__(self, items: Sequence[tuple[str, bytes]], window: int = WINDOW):
        self.symbol: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for name, text in items:
            ids = [self.symbol.setdefault(w, len(self.symbol) + FIRST) for w in word_list(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                owners[tuple(ids[i : i + window])].add(name)
        by_length: dict[int, list] = defaultdict(list)
        for phrase, names in owners.items():
            by_length[len(phrase)].append((phrase, sorted(names)))
        self.groups = [
            (length, np.array([p for p, _ in found], dtype=np.int64), [n for _, n in found])
            for length, found in sorted(by_length.items())
        ]
        self.shortest = min(by_length, default=0)

    @property
    def n_symbols(self) -> int:
        return len(self.symbol) + FIRST

    def symbols(self, text: bytes | None) -> np.ndarray:
        """A text as symbols with a separator at its end; long texts go piece by piece."""
        folded, parts, at = (text or b"").translate(_FOLD), [], 0
        while at < len(folded):
            end = at + SHARD_BYTES
            if end < len(folded):
                cut = folded.rfind(b" ", at, end)
                # A word longer than a piece is not cut.
                end = cut if cut > at else folded.find(b" ", end)
                end = len(folded) if end < 0 else end
            found = folded[at:end].split()
            parts.append(
                np.fromiter(map(self.symbol.get, found, repeat(OTHER)), np.int32, len(found))
            )
            at = end
        parts.append(np.array([OTHER], dtype=np.int32))
        return np.concatenate(parts)


def occurrences(sequence: np.ndarray, phrases: Phrases) -> Iterator[tuple[int, np.ndarray, np.ndarray, list]]:
    """Per phrase length: the length, starts in the sequence, phrase numbers, phrase owners."""
    known = np.concatenate([[0], (sequence >= FIRST).astype(np.int8), [0]])
    edges = np.flatnonzero(np.diff(known))
    begin, end = edges[::2], edges[1::2]
    fits = end - begin >= phrases.shortest
    if not len(begin) or not fits.any():
        return
    # Runs that can hold a phrase, each with the separator after it.
    change = np.zeros(len(sequence) + 2, dtype=np.int32)
    np.add.at(change, begin[fits], 1)
    np.add.at(change, end[fits] + 1, -1)
    origin = np.flatnonzero(np.cumsum(change)[: len(sequence)])
    index = FmIndex(np.append(sequence[origin], END).astype(np.int64), phrases.n_symbols)
    for length, wanted, owners in phrases.groups:
        low, high = index.search(wanted)
        count = high - low
        which = np.repeat(np.arange(len(wanted)), count)
        rows = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(len(which))
        if len(rows):
            yield length, origin[index.locate(rows)], which, owners


def marked_batch(texts: list[bytes | None], phrases: Phrases):
    """Per text: number of words, merged spans of words as pairs, names of items."""
    n_words, spans, names = [], [], []
    at = 0
    while at < len(texts):
        parts, size, end = [], 0, at
        while end < len(texts) and (end == at or size + len(texts[end] or b"") <= SHARD_BYTES):
            parts.append(phrases.symbols(texts[end]))
            size += len(texts[end] or b"")
            end += 1
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        sequence = np.concatenate(parts)
        change = np.zeros(len(sequence) + 1, dtype=np.int32)
        items: dict[int, set[str]] = defaultdict(set)
        for length, starts, which, owners in occurrences(sequence, phrases):
            np.add.at(change, starts, 1)
            np.add.at(change, starts + length, -1)
            text = np.searchsorted(offsets, starts, side="right") - 1
            for t, w in np.unique(np.stack([text, which], axis=1), axis=0):
                items[int(t)].update(owners[w])
        inside = np.concatenate([[0], (np.cumsum(change) > 0).astype(np.int8)])
        edges = np.flatnonzero(np.diff(inside))
        found: dict[int, list] = defaultdict(list)
        for b, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            t = int(np.searchsorted(offsets, b, side="right") - 1)
            found[t].append((b - int(offsets[t]), e - int(offsets[t])))
        for i, part in enumerate(parts):
            n_words.append(len(part) - 1)
            spans.append(found.get(i, []))
            names.append(sorted(items.get(i, ())))
        at = end
    return n_words, spans, names


def merged(a: list, b: list) -> list:
    """The union of two lists of spans."""
    out: list = []
    for start, end in sorted([*map(tuple, a), *map(tuple, b)]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def without_spans(text: bytes, spans: list) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*out, text[at:]])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _pass(shared, last: bool, cut: bool):
    """One block of phrases over the batches of a task."""

    def run(batches):
        phrases = shared.value
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            n_words, spans, names = marked_batch(texts, phrases)
            earlier = batch.column("spans").to_pylist()
            known = batch.column("items").to_pylist()
            spans = [
                merged([(x["start"], x["end"]) for x in e], s) if e else s
                for e, s in zip(earlier, spans, strict=True)
            ]
            names = [sorted({*k, *n}) if k else n for k, n in zip(known, names, strict=True)]
            if last and cut:
                texts = [without_spans(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
            made = {
                "_text": pa.array(texts if cut or not last else [None] * len(texts), pa.binary()),
                "n_words": pa.array(n_words, pa.int64()),
                "spans": pa.array([[{"start": b, "end": e} for b, e in s] for s in spans], _SPANS),
                "items": pa.array(names, pa.list_(pa.string())),
            }
            columns = [made.get(f.name, batch.column(f.name)) for f in batch.schema]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in batch.schema])

    return run


def blocks_of(benchmark: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks whose text has a bounded number of bytes, as checked by a sum."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.col("text").cast("binary").alias("text")
    ).where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    # Half-full blocks on average leave room for uneven ones.
    count = max(1, -(-total // (BLOCK_BYTES // 2)))
    for b in range(count):
        chosen = items if count == 1 else items.where(F.pmod(F.xxhash64("name"), F.lit(count)) == b)
        yield [(r["name"], bytes(r["text"])) for r in chosen.collect()]


def marked(docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] = ("doc_id",), cut: bool = False) -> DataFrame:
    """``keep``, n_words, merged ``spans`` of words and ``items``; ``cut`` also gives the ``clean`` text."""
    spark = docs.sparkSession
    schema = T.StructType(
        [
            T.StructField("_keep", T.StructType([docs.schema[c] for c in keep])),
            T.StructField("_text", T.BinaryType()),
            T.StructField("n_words", T.LongType()),
            T.StructField(
                "spans",
                T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
            ),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
    rows = docs.select(
        F.struct(*keep).alias("_keep"),
        F.col("text").cast("binary").alias("_text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(schema["spans"].dataType).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    blocks = [spark.sparkContext.broadcast(Phrases(b)) for b in blocks_of(benchmark)]
    for i, block in enumerate(blocks):
        rows = rows.mapInArrow(_pass(block, i == len(blocks) - 1, cut), schema)
    clean = [F.col("_text").cast("string").alias("clean")] if cut else []
    return rows.select(
        *(F.col("_keep")[c].alias(c) for c in keep), "n_words", "spans", "items", *clean
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents with every removal span cut out of the text and n_chars counted again."""
    found = marked(packed(docs), benchmark, ["_row"], cut=True)
    changed = F.size("spans") > 0

    def column(name: str) -> Column:
        old = F.col("_row")[name]
        if name == "text":
            return F.when(changed, F.col("clean")).otherwise(old).alias(name)
        if name == "n_chars":
            return F.when(changed, F.length("clean").cast("bigint")).otherwise(old).alias(name)
        return old.alias(name)

    return found.select(*map(column, docs.columns))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Counts and a digest of the items per document."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    listed = F.array_join(F.array_sort("items"), ",")
    return marked(docs, benchmark).select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def brute_force(text: str | None, items: Sequence[tuple[str, str]]) -> tuple[int, int, list[str]]:
    """Words, hit words and items of one text, by comparing every window; for tests."""
    w = word_list(text.encode()) if text else []
    hit: set[int] = set()
    names = []
    for name, item in items:
        v = word_list(item.encode())
        size = min(WINDOW, len(v))
        windows = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if v else set()
        at = [i for i in range(len(w) - size + 1) if tuple(w[i : i + size]) in windows] if v else []
        hit.update(j for i in at for j in range(i, i + size))
        names += [name] if at else []
    return len(w), len(hit), sorted(names)

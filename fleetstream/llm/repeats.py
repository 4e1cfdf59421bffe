"""Removal of long repeats with run-length indexes of the repetitive parts of a corpus.

A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else.
All such strings (windows) of all documents are judged, exactly:

1. Every window gets an anchor, the 32 bytes in it with the least digest.  Equal windows
   have equal anchors at the same place, so only windows whose anchor occurs again can
   repeat.  Neighbouring windows with one anchor form a context: the bytes they cover.
2. Contexts meet by anchor.  Equal contexts repeat wholly.  A context that occurs once, but
   whose anchor has other contexts, has to be compared with those.
3. For that, a run-length index is built over the contexts of an anchor: a suffix array
   gives the Burrows-Wheeler transform, of which runs are kept, with the suffix positions
   at both ends of every run.  The longest match of a position with its neighbour in suffix
   order is only computed at run ends; from there it falls by one per position, so the
   matching statistics of all positions are one stream over the text.  Windows whose match
   reaches ``length`` are repeats.

A task drops from the exchange by anchor what it has already sent twice (such contexts are
known to repeat), so copies in any number meet as at most two rows per task.  Anchors with
many different contexts are crowded: their windows are told apart singly, by anchor and
digest, and again a task sends a window twice at most.  A task that has sent so many contexts
of an anchor knows that it is crowded and keeps the others of it from the exchange by anchor.
Matching needs no pairs and no components.

Defined cases: null and empty texts, and texts shorter than ``length``, are kept whole;
null ids are kept; equal rows repeat each other; other columns are ignored; an empty table
gives an empty result; long texts are cut into tiles that overlap by a window less one
byte.  Matches never cross documents.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from fleetstream.llm.common import row_key, written

LENGTH = 200
ANCHOR = 32
TILE = 1 << 17
# Contexts a task remembers having sent; beyond it starts anew, which only sends more.
SENT_KNOWN = 500_000
# Contexts of one anchor beyond which their windows are judged singly.
MANY_CONTEXTS = 64
# Bytes of contexts in one index.
INDEX_BYTES = 1 << 20
SEPARATOR = 0xFF  # in no UTF-8 text

SURE, ASK, TEXT_ONLY = 0, 1, 2

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xE7037ED1A0B428DB)]


# --- anchors


def _eights(data: bytes) -> np.ndarray:
    """The eight bytes from every position as a number."""
    return np.ndarray(shape=(max(len(data) - 7, 0),), dtype="<u8", buffer=data, strides=(1,))


def anchor_runs(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digest and place of each anchor with the first and last window that has it."""
    n = len(data) - length + 1
    size = min(ANCHOR, length)
    count = len(data) - size + 1
    mixed = _eights(data + b"\0" * 8) * _M[0]
    mixed ^= mixed >> np.uint64(29)
    digest = mixed[:count] * _M[1]
    for i, place in enumerate(range(8, size - 7, 8)):
        digest += mixed[place : place + count] * _M[2 + i % 2]
        digest ^= digest >> np.uint64(31)
    digest *= _M[4]
    low = np.uint64((1 << 24) - 1)
    # The least digest, and the first place of it: both in one number.
    least = (digest & ~low) | np.arange(count, dtype=np.uint64)
    width, step = length - size + 1, 1
    while step * 2 <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if width > step:
        least = np.minimum(least[: step - width], least[width - step :])
    place = (least[:n] & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:] - 1, [n - 1]])
    at = place[first]
    return digest[at].view(np.int64), at, first, last


def contexts(texts: list[bytes | None], length: int = LENGTH):
    """Arrays over the contexts of some texts: anchor digest, context digest, number of the
    text, first and last window start in it.  Short texts share a tile, long ones are cut."""
    parts = []
    for numbers, begins, tile, sizes in _tiles(texts, length):
        place_h, _, first, last = anchor_runs(tile, length)
        # A window must lie in one text: cut the runs at the texts' last windows.
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        which = np.searchsorted(offsets, first, side="right") - 1
        spill = np.searchsorted(offsets, last, side="right") - 1
        count = spill - which + 1
        row = np.repeat(np.arange(len(first)), count)
        text = which[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        begin = np.maximum(first[row], offsets[text])
        end = np.minimum(last[row], offsets[text + 1] - length)
        good = begin <= end
        row, text, begin, end = row[good], text[good], begin[good], end[good]
        d = np.fromiter(
            (xxh3_64_intdigest(tile[a : b + length]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)),
            dtype=np.uint64,
            count=len(begin),
        ).view(np.int64)
        shift = (np.array(begins) - offsets[:-1])[text]
        parts.append((place_h[row], d, np.array(numbers)[text], begin + shift, end + shift))
    if not parts:
        return None
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _tiles(texts: list[bytes | None], length: int):
    """Numbers of texts, where their pieces begin, the joined pieces and their sizes."""
    numbers, begins, pieces, size = [], [], [], 0

    def tile():
        return list(numbers), list(begins), b"".join(pieces), [len(p) for p in pieces]

    for i, text in enumerate(texts):
        for begin in range(0, max(len(text or b"") - length + 1, 0), TILE):
            piece = text[begin : begin + TILE + length - 1]
            if size and size + len(piece) > TILE + length:
                yield tile()
                numbers, begins, pieces, size = [], [], [], 0
            numbers.append(i)
            begins.append(begin)
            pieces.append(piece)
            size += len(piece)
    if size:
        yield tile()


_ANCHOR_SCHEMA = "deal bigint, h bigint, d bigint, key bigint, first bigint, last bigint, known boolean, crowded boolean"


def _anchors(length: int, many: int):
    def run(batches):
        sent: dict[int, int] = {}
        of_anchor: dict[int, int] = {}
        for batch in batches:
            keys, texts = batch.column("key").to_numpy(), batch.column("text").to_pylist()
            found = contexts(texts, length)
            if found is None:
                continue
            h, d, number, first, last = found
            key = keys[number].astype(np.int64)
            # What the task has sent twice is known to repeat and need not be compared.
            known = np.zeros(len(h), dtype=bool)
            # Contexts beyond those that show the exchange that their anchor is crowded.
            crowded = np.zeros(len(h), dtype=bool)
            if len(sent) > SENT_KNOWN:
                sent.clear()
                of_anchor.clear()
            get, kinds = sent.get, of_anchor.get
            for i, (x, a) in enumerate(zip((h ^ d).tolist(), h.tolist(), strict=True)):
                n = get(x, 0)
                if n >= 2:
                    known[i] = True
                elif n:
                    sent[x] = 2
                elif (k := kinds(a, 0)) <= many:
                    sent[x], of_anchor[a] = 1, k + 1
                else:
                    crowded[i] = True
            h, d, key, first, last, known, crowded = _runs_joined(h, d, key, first, last, known, crowded)
            deal = np.where(known | crowded, first * 7919 + key, h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (deal, h, d, key, first, last, known, crowded)],
                ["deal", "h", "d", "key", "first", "last", "known", "crowded"],
            )

    return run


def _runs_joined(h, d, key, first, last, known, crowded):
    """Rows in which neighbouring known contexts of a text are one, under the first one's digests.

    Their windows follow each other, so a text of one period is a few rows whatever its length.
    """
    seen = np.flatnonzero(known)
    if not len(seen):
        return h, d, key, first, last, known, crowded
    seen = seen[np.lexsort((first[seen], key[seen]))]
    apart = (key[seen][1:] != key[seen][:-1]) | (first[seen][1:] > last[seen][:-1] + 1)
    starts = np.flatnonzero(np.concatenate([[True], apart]))
    ends = np.maximum.reduceat(last[seen], starts)
    rest, heads = np.flatnonzero(~known), seen[starts]
    pick = np.concatenate([rest, heads])
    last = np.concatenate([last[rest], ends])
    return h[pick], d[pick], key[pick], first[pick], last, known[pick], crowded[pick]


# --- what an anchor's contexts have in common


_FLAG_SCHEMA = "key bigint, first bigint, last bigint, kind int, h bigint, many boolean"


def _flagged(many: int):
    """Rows sorted by anchor and context: which contexts repeat, which have to be compared.

    Works on a stream of batches; the rows of an anchor that spans batches are carried: of a
    task's rows at most two for each of ``many`` and one contexts.  Contexts beyond
    those are asked for as they are.
    """

    def beyond(t: dict):
        n = len(t["h"])
        return pa.RecordBatch.from_arrays(
            [pa.array(t[c]) for c in ("key", "first", "last")]
            + [pa.array(np.full(n, ASK, dtype=np.int32)), pa.array(t["h"]), pa.array(np.ones(n, dtype=bool))],
            ["key", "first", "last", "kind", "h", "many"],
        )

    def judged(t: dict):
        h, d, known = t["h"], t["d"], t["known"]
        n = len(h)
        if not n:
            return None
        new_h = np.concatenate([[True], h[1:] != h[:-1]])
        new_d = new_h | np.concatenate([[True], d[1:] != d[:-1]])
        of_d = np.cumsum(new_d) - 1
        count = np.bincount(of_d)[of_d]
        of_h = np.cumsum(new_h) - 1
        kinds = np.bincount(of_h, weights=new_d)[of_h]
        same = (count >= 2) | known
        alone = (count == 1) & (kinds >= 2) & ~known
        text = new_d & (count >= 2) & (kinds >= 2)
        pick = np.concatenate([np.flatnonzero(same), np.flatnonzero(alone), np.flatnonzero(text)])
        kind = np.repeat([SURE, ASK, TEXT_ONLY], [same.sum(), alone.sum(), text.sum()]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(t[c][pick]) for c in ("key", "first", "last")]
            + [pa.array(kind), pa.array(h[pick]), pa.array(kinds[pick] > many)],
            ["key", "first", "last", "kind", "h", "many"],
        )

    names = ("h", "d", "key", "first", "last", "known")

    def run(batches):
        held = None
        for batch in batches:
            t = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            crowded = batch.column("crowded").to_numpy(zero_copy_only=False)
            if crowded.any():
                yield beyond({c: t[c][crowded] for c in names})
                t = {c: t[c][~crowded] for c in names}
            if held:
                t = {c: np.concatenate([held[c], t[c]]) for c in names}
            # The last anchor may go on in the next batch.
            cut = int(np.searchsorted(t["h"], t["h"][-1], side="left")) if len(t["h"]) else 0
            done, held = {c: t[c][:cut] for c in names}, {c: t[c][cut:] for c in names}
            if (out := judged(done)) is not None and out.num_rows:
                yield out
        if held and (out := judged(held)) is not None and out.num_rows:
            yield out

    return run


def flags(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Contexts that repeat, that have to be compared, or that others are compared with."""
    # Passed on, so that all tasks agree on which anchors are crowded.
    many = MANY_CONTEXTS
    found = texts.where(F.octet_length("text") >= length).mapInArrow(_anchors(length, many), _ANCHOR_SCHEMA)
    dealt = found.repartition("deal").sortWithinPartitions("h", "d")
    return dealt.drop("deal").mapInArrow(_flagged(many), _FLAG_SCHEMA)


# --- the index


class RunLengthIndex:
    """Run-compressed transform of a text of contexts, each followed by a separator.

    ``heads`` and ``tails`` are the suffix positions at the first and last row of every run.
    """

    def __init__(self, text: np.ndarray, least: int = 0):
        """Matches shorter than ``least`` may count as none."""
        self.text = text
        order, self._long = suffix_order(text, least)
        before = np.where(order > 0, text[order - 1], SEPARATOR)
        # Every separator is a symbol of its own, so a run of them is none.
        new = np.concatenate([[True], (before[1:] != before[:-1]) | (before[1:] == SEPARATOR)])
        start = np.flatnonzero(new)
        end = np.concatenate([start[1:] - 1, [len(order) - 1]])
        self.symbols, self.lengths = before[start], end - start + 1
        self.heads, self.tails = order[start], order[end]
        # The rows next to the run ends, to which the matches are measured.
        self._above = (order[start[1:]], order[start[1:] - 1])
        self._below = (order[end[:-1]], order[end[:-1] + 1])

    def matching_statistics(self) -> np.ndarray:
        """Per position the length of its longest match that starts anywhere else."""
        n = len(self.text)
        data = self.text.tobytes() + bytes([SEPARATOR]) * 8
        eight = _eights(data)
        at = np.arange(n)
        best = np.zeros(n, dtype=np.int64)
        for here, other in (self._above, self._below):
            sample = np.full(n, -1, dtype=np.int64)
            can = self._long[here] & self._long[other]
            here, other = here[can], other[can]
            sample[here] = common_length(eight, here, other)
            # Between samples a match loses its first byte at every step.
            best = np.maximum(best, np.maximum.accumulate(sample + at) - at)
        return best


def suffix_order(text: np.ndarray, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes, and which of them share a long prefix with another.

    Separators sort last and by position.  ``least`` bounds what counts as long from above.
    """
    n = len(text)
    ends = np.flatnonzero(text == SEPARATOR)
    to_end = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(n)
    padded = np.concatenate([text, np.full(8, SEPARATOR, dtype=np.uint8)]).tobytes()
    key = _eights(padded)[:n].byteswap()
    near = to_end < 8
    # From the separator on, all bytes count as separators.
    mask = (np.uint64(0xFFFFFFFFFFFFFFFF) >> (to_end[near].astype(np.uint64) * np.uint64(8)))
    key[near] |= mask
    order = np.argsort(key)
    ranked = key[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = begin
    # Suffixes that reach a separator are told apart by its position.
    close = np.flatnonzero(near)
    close = close[np.lexsort((close + to_end[close], rank[close]))]
    same = np.concatenate([[True], rank[close][1:] != rank[close][:-1]])
    nth = np.arange(len(close))
    rank[close] += nth - np.maximum.accumulate(np.where(same, nth, 0))
    size = np.bincount(rank, minlength=n)
    open_ = np.flatnonzero(size[rank] > 1)
    long_, step = np.ones(n, dtype=bool), 8
    while len(open_):
        if step <= least:
            long_[:] = False
            long_[open_] = True
        key = rank[open_] << 32 | rank[open_ + step]
        by = np.argsort(key)
        open_, key = open_[by], key[by]
        old = rank[open_]
        nth = np.arange(len(open_))
        group = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), nth, 0))
        new_part = np.concatenate([[True], key[1:] != key[:-1]])
        part = np.maximum.accumulate(np.where(new_part, nth, 0))
        rank[open_] = old + part - group
        alone = new_part & np.concatenate([new_part[1:], [True]])
        open_ = open_[~alone]
        step *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order, long_


def common_length(eight: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal bytes from two positions on; ``eight`` has the bytes from each."""
    out = np.zeros(len(a), dtype=np.int64)
    todo, size, at = np.arange(len(a)), len(eight), 0
    while len(todo):
        x, y = a[todo] + at, b[todo] + at
        inside = (x < size) & (y < size)
        todo, x, y = todo[inside], x[inside], y[inside]
        differ = eight[x] ^ eight[y]
        equal = differ == 0
        part = todo[~equal]
        rest = differ[~equal]
        # The first bytes are the low ones: count those that do not differ.
        low = (rest & (~rest + np.uint64(1))).astype(np.float64)
        out[part] = at + np.log2(low).astype(np.int64) // 8
        todo = todo[equal]
        at += 8
        out[todo] = at
    return out


def _compared(length: int):
    """Contexts sorted by group: the runs of windows of the asked ones that repeat."""

    def answer(rows: list):
        sizes = np.array([len(r[2]) for r in rows])
        text = np.frombuffer(b"".join(r[2] + b"\xff" for r in rows), dtype=np.uint8)
        match = RunLengthIndex(text, length).matching_statistics()
        begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        asked = np.array([r[3] for r in rows])
        which = np.repeat(np.arange(len(rows)), sizes + 1)
        inside = np.arange(len(text)) - begin[which] <= sizes[which] - length
        hit = np.concatenate([[0], (inside & asked[which] & (match >= length)).astype(np.int8), [0]])
        edge = np.flatnonzero(np.diff(hit))
        out = []
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            # Windows of two contexts are never neighbours: a separator is between them.
            key, first = rows[which[a]][:2]
            start = first + a - int(begin[which[a]])
            out.append((key, start, start + b - a - 1 + length))
        return out

    def run(batches):
        rows: list = []
        size, group = 0, None
        held = None
        for batch in batches:
            single = pc.is_null(batch.column("bytes"))
            windows = pa.Table.from_batches([batch]).filter(single)
            batch = pa.Table.from_batches([batch]).filter(pc.invert(single))
            if windows.num_rows:
                t = {c: windows.column(c).to_numpy() for c in ("g", "h", "key", "first", "last", "ask", "known")}
                if held:
                    t = {c: np.concatenate([held[c], t[c]]) for c in t}
                # The last window may have rows in the next batch: it is carried.
                cut = _window_start(t)
                yield _repeated_windows({c: x[:cut] for c, x in t.items()}, length)
                held = {c: x[cut:] for c, x in t.items()}
            out = []
            for g, *row in zip(*(batch.column(c).to_pylist() for c in ("g", "key", "first", "bytes", "ask")), strict=True):
                if g != group and size > INDEX_BYTES:
                    out += answer(rows)
                    rows, size = [], 0
                group = g
                rows.append(row)
                size += len(row[2])
            yield _span_batch(out)
        if rows:
            yield _span_batch(answer(rows))
        if held:
            yield _repeated_windows(held, length)

    return run


def _window_start(t: dict) -> int:
    """Where the rows of the last window begin, in rows sorted by digest and anchor."""
    same = (t["g"] == t["g"][-1]) & (t["h"] == t["h"][-1])
    return len(same) - int(np.argmin(same[::-1])) if not same.all() else 0


def _repeated_windows(t: dict, length: int) -> pa.RecordBatch:
    """Spans of the asked windows that are known to repeat or are there twice."""
    g, h = t["g"], t["h"]
    if not len(g):
        return _span_batch([])
    of = np.cumsum(np.concatenate([[True], (g[1:] != g[:-1]) | (h[1:] != h[:-1])])) - 1
    hit = t["ask"] & (t["known"] | (np.bincount(of)[of] >= 2))
    return pa.RecordBatch.from_arrays(
        [pa.array(t["key"][hit]), pa.array(t["first"][hit]), pa.array(t["last"][hit] + length)],
        ["key", "start", "end"],
    )


def _span_batch(spans: list) -> pa.RecordBatch:
    columns = list(zip(*spans, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["key", "start", "end"]
    )


_CUT_SCHEMA = "g bigint, h bigint, key bigint, first bigint, last bigint, bytes binary, ask boolean, known boolean"


def _cut_contexts(length: int):
    """The bytes of flagged contexts; of crowded anchors the digests of their windows.

    What the task has sent twice of these is known to repeat, and its runs need no exchange.
    """

    def run(batches):
        sent: dict[int, int] = {}
        for batch in batches:
            out = []
            if len(sent) > SENT_KNOWN:
                sent.clear()
            get = sent.get
            for key, text, found in zip(
                *(batch.column(c).to_pylist() for c in ("key", "text", "found")), strict=True
            ):
                for x in found:
                    h, first, last, ask = x["h"], x["first"], x["last"], x["kind"] == ASK
                    if not x["many"]:
                        out.append((h, h, key, first, last, text[first : last + length], ask, False))
                        continue
                    run_start = None
                    for at in range(first, last + 1):
                        digest = xxh3_64_intdigest(text[at : at + length])
                        n = get(digest ^ h, 0)
                        if n >= 2:
                            if run_start is None:
                                run_start = at
                            continue
                        sent[digest ^ h] = n + 1
                        if ask and run_start is not None:
                            out.append((at * 7919 + key % 7907, h, key, run_start, at - 1, None, True, True))
                        run_start = None
                        out.append((digest - (1 << 63), h, key, at, at, None, ask, False))
                    if ask and run_start is not None:
                        out.append((last * 7919 + key % 7907, h, key, run_start, last, None, True, True))
            columns = zip(*out, strict=True) if out else ([],) * 8
            kinds = (*(pa.int64(),) * 5, pa.binary(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["g", "h", "key", "first", "last", "bytes", "ask", "known"],
            )

    return run


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``key, spans``: byte ranges of repeated windows (they may overlap) per text.

    ``texts`` are ``key`` and ``text`` as bytes.
    """
    flagged = written(flags(texts, length), "repeat-flags")
    sure = flagged.where(F.col("kind") == SURE).select(
        "key", F.col("first").alias("start"), (F.col("last") + length).alias("end")
    )
    asked = (
        flagged.where(F.col("kind") != SURE)
        .groupBy("key")
        .agg(F.collect_list(F.struct("first", "last", "kind", "h", "many")).alias("found"))
    )
    cut = texts.join(asked, "key").mapInArrow(
        _cut_contexts(length), _CUT_SCHEMA
    )
    dealt = cut.repartition("g").sortWithinPartitions("g", "h")
    compared = dealt.mapInArrow(_compared(length), "key bigint, start bigint, end bigint")
    return (
        sure.unionByName(compared)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )


def _kept(with_text: bool):
    def run(batches):
        for batch in batches:
            n_bytes, n_removed, n_spans, digests, kept = [], [], [], [], []
            for text, spans in zip(
                batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True
            ):
                text = text or b""
                at, parts, removed, count = 0, [], 0, 0
                for x in spans or ():
                    if count and x["start"] <= at:
                        grown = max(at, x["end"])
                        removed += grown - at
                        at = grown
                        continue
                    parts.append(text[at : x["start"]])
                    removed += x["end"] - x["start"]
                    count, at = count + 1, x["end"]
                rest = b"".join([*parts, text[at:]])
                n_bytes.append(len(text))
                n_removed.append(removed)
                n_spans.append(count)
                digests.append(sha256(rest).hexdigest())
                kept.append(rest if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(n_spans, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return run


def without_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """``doc_id``, the counts, the digest of what is left and, if wanted, its bytes ``kept``."""
    rows = docs.select(
        row_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", F.col("text").cast("binary").alias("text")
    )
    spans = repeated_spans(rows, length)
    joined = rows.join(spans, "key", "left").select("doc_id", "text", "spans")
    schema = joined.select(
        "doc_id",
        *(F.lit(0).cast("bigint").alias(c) for c in ("n_bytes", "n_removed", "n_spans")),
        F.lit("").alias("kept_sha256"),
        F.lit(b"").alias("kept"),
    ).schema
    for field in schema.fields:
        field.nullable = True
    return joined.mapInArrow(_kept(with_text), schema)


def report(docs: DataFrame) -> DataFrame:
    return without_repeats(docs, with_text=False).drop("kept")

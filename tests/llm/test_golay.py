"""Fuzzy hashing by the Golay code: its guarantees, and components against all pairs."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from xxhash import xxh64_intdigest

from fleetstream.llm import golay
from tests.llm.conftest import LONG, odd_rows, prose


def brute_print(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lower.encode().translate(bytes(32 if 9 <= c <= 13 else c for c in range(256))).split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    digests = [xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(d >> b & 1 for d in digests) > len(digests))


def brute_parts(prints):
    part = {p: p for p in prints}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in combinations(sorted(part), 2):
        if (a ^ b).bit_count() <= 4:
            part[root(a)] = root(b)
    return {p: root(p) for p in part}


def brute(rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    parts = brute_parts({p for _, p in prints})
    least = {}
    for i, p in prints:
        if i is not None:
            least[parts[p]] = min(least.get(parts[p], i), i)
    return sorted(((i, f"{p:016x}", least.get(parts[p])) for i, p in prints), key=repr)


def grouped(df, **options):
    found = golay.grouped(df, **options).select("doc_id", "fingerprint", "component_id")
    return sorted(map(tuple, found.collect()), key=repr)


def test_code_is_perfect_and_corrects_three_errors():
    words = np.arange(1 << 12, dtype=np.int64) << 11
    words = np.array([w | golay._remainder(w) for w in words.tolist()])
    assert np.bitwise_count(words[1:]).min() == 7
    assert (golay._ERRORS > 0).sum() == 2047 and np.bitwise_count(golay._ERRORS).max() == 3
    rng = np.random.default_rng(1)
    for weight in range(4):
        errors = np.array([sum(1 << b for b in rng.choice(23, weight, replace=False)) for _ in words], dtype=np.int64)
        assert (golay.decoded(words ^ errors) == np.arange(1 << 12)).all()


@pytest.mark.parametrize("width", [21, 22])
def test_words_two_bits_apart_share_a_near_codeword(width):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << width, 3000)
    near, new = golay.near_codewords(a, width)
    assert 1 <= new.sum(axis=1).min() and new.sum(axis=1).max() <= 6
    for i in range(0, 3000, 7):
        one, two = rng.choice(width, 2, replace=False).tolist()
        b = a[i : i + 1] ^ (1 << one)
        assert golay.decoded(b)[0] in near[i]
        assert set(golay.near_codewords(b ^ (1 << two), width)[0][0]) & set(near[i])


def _keys(function, prints):
    batch = pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64))], ["print"])
    found = {}
    for made in function([batch]):
        for k, p in zip(made.column("key").to_pylist(), made.column("print").to_pylist(), strict=True):
            found.setdefault(p, set()).add(k)
    return found


@pytest.mark.parametrize("keys", [golay._fuzzy_keys, golay._byte_keys])
def test_four_errors_anywhere_leave_a_common_key(keys):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    errors = [sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)) for _ in a]
    b = a ^ np.array(errors, dtype=np.uint64)
    one, two = _keys(keys, a), _keys(keys, b)
    assert all(one[x] & two[y] for x, y in zip(a.view(np.int64).tolist(), b.view(np.int64).tolist(), strict=True))


def test_every_choice_of_half_bytes_keeps_48_bits():
    masks = golay._nibble_masks(golay.BYTE_MASKS[17])
    assert len(set(masks)) == 70 and {m.bit_count() for m in masks} == {48}


def test_fingerprints(monkeypatch):
    monkeypatch.setattr(golay, "SHINGLES", 1000)
    for _, text, *_ in odd_rows():
        text = text[:60_000] if text else text
        assert golay.fingerprint(None if text is None else text.encode()) == brute_print(text)
    assert golay.fingerprint("A b\tC\x0bd e".encode()) == brute_print("a b c d e") == brute_print("A b\tC\x0bd e")


@pytest.mark.parametrize("crowded", [golay.CROWDED, 3, 1])
def test_links_connect_what_all_pairs_connect(spark, crowded):
    pick = random.Random(crowded)
    prints = set()
    for _ in range(60):
        p = pick.getrandbits(64)
        for _ in range(pick.choice([1, 3, 30])):
            prints.add(p)
            for b in pick.sample(range(64), pick.randint(0, 5)):
                p ^= 1 << b
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "print long")
    found = {tuple(x % (1 << 64) for x in r) for r in golay.links(df, crowded).collect()}
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    parts = brute_parts(prints)
    linked = {p: p for p in prints}

    def root(x):
        while linked[x] != x:
            x = linked[x]
        return x

    for a, b in found:
        linked[root(a)] = root(b)
    assert len({root(p) for p in prints}) == len(set(parts.values()))


def test_components_equal_all_pairs(spark):
    pick = random.Random(4)
    rows = [(900, None), (901, ""), (902, " \n"), (None, "an id is missing here"), (None, "an id is missing here")]
    for i in range(80):
        words = prose(i // 4, 400).split(" ")
        for _ in range(i % 4):
            words[pick.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[7][1]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = grouped(df)
    assert found == brute(rows)
    assert 20 < len({r[2] for r in found}) < 85


def test_defined_cases(odd, none):
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert len(LONG) > 500_000 and grouped(odd) == brute(rows)
    assert grouped(none) == []

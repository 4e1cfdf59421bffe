"""Spelling variants against a comparison of all words."""

import collections
import random
import re
import zlib

import pytest

from fleetstream.llm import spelling
from tests.llm.conftest import odd_rows

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            key = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if key % 97 == 0:
                at = key % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    form, out = {}, []
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
        out.append([w, form.get(w), w, n, len(others), words.get(form.get(w))])
    for row in out:
        while row[2] in form:
            row[2] = form[row[2]]
    return sorted(map(tuple, out), key=repr)


def variants(df, **options):
    return sorted((tuple(r[c] for c in COLUMNS) for r in spelling.variants(df, **options).collect()), key=repr)


def misspelt_corpus(seed, n_words=120, n_docs=60):
    pick = random.Random(seed)
    letters = "abcdeé"
    words = ["".join(pick.choice(letters) for _ in range(pick.randint(5, 9))) for _ in range(n_words)]
    words += ["lllll", "llllll", "lllllll", "banana", "bannana", "ananab", "straße", "strasse", "ÉCOLE", "éCole"]
    rows = []
    for i in range(n_docs):
        said = []
        for _ in range(60):
            w = words[int(len(words) * pick.random() ** 2)]
            if pick.random() < 0.3:
                at = pick.randrange(len(w))
                w = pick.choice([w[:at] + w[at + 1 :], w[:at] + pick.choice(letters) + w[at:], w[:at] + pick.choice(letters) + w[at + 1 :]])
            said.append(w.upper() if pick.random() < 0.1 else w)
        rows.append((i, pick.choice([" ", ", ", "1", "\n"]).join(said)))
    return rows


@pytest.mark.parametrize(("seed", "crowded"), [(1, spelling.CROWDED), (2, 2), (3, 0)])
def test_variants_equal_a_comparison_of_all_words(spark, seed, crowded):
    rows = misspelt_corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = variants(df, crowded=crowded)
    assert found == brute_variants(rows)
    assert sum(r[1] is not None for r in found) > 20


def test_near_words_share_a_signature(spark):
    """The lemma behind the join, on all edits of some words."""
    pick = random.Random(5)
    pairs = set()
    for _ in range(40):
        w = "".join(pick.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(pick.randint(5, 14)))
        for at in range(len(w)):
            pairs |= {(w, w[:at] + w[at + 1 :]), (w, w[:at] + pick.choice("aeé") + w[at + 1 :])}
    words = sorted({x for p in pairs for x in p})
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    have = collections.defaultdict(set)
    for r in spelling.signatures(df).collect():
        have[r["word"]].add((r["sig"], (0, 0) if r["role"] == 0 else (1, 2)))
    assert all(have[a] & have[b] for a, b in pairs if a != b)


def test_chains_of_forms(spark):
    """aaaaa < aaaab < aaabb ... each twice as frequent: all roots are the last."""
    chain = ["a" * (6 - i) + "b" * i for i in range(6)]
    counted = [(w, 3 * 2**i) for i, w in enumerate(chain)]
    forms = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)), "word string, form string")
    roots = dict(spelling._roots(forms).collect())
    assert roots == {w: chain[-1] for w in chain[:-1]}
    assert len(counted) == 6


def test_defined_cases(odd, none):
    assert variants(odd) == brute_variants([(r[0], r[1]) for r in odd_rows()])
    assert variants(none) == []


def test_very_long_runs(spark):
    rows = [(i, "x" * 20_000 + end) for i, end in enumerate(["", "", "", "y", "y", "y"])]
    found = variants(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [(len(r[0]), r[1], *r[3:]) for r in found] == [(20_000, None, 3, 1, None), (20_001, None, 3, 1, None)]

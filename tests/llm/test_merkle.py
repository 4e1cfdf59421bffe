"""The Merkle manifest against a plain construction, and its odd rows."""

import hashlib
import heapq
import zlib

import pytest
from pyspark.sql import functions as F

from fleetstream.llm import merkle
from tests.llm.conftest import odd_rows


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(doc_id, source, lang, n_chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def brute_tree(digests):
    """The root, and for every leaf the digests left and right of its path."""
    level, places, proofs = list(digests), list(range(len(digests))), [[] for _ in digests]
    while len(level) > 1:
        for proof, at in zip(proofs, places, strict=True):
            first = at - at % 8
            proof.append(("".join(level[first:at]), "".join(level[at + 1 : first + 8])))
        level = [h(*level[i : i + 8]) for i in range(0, len(level), 8)]
        places = [at // 8 for at in places]
    return (level[0] if level else None), proofs


def brute_report(rows):
    trees = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        own = brute_leaf(doc_id, source, lang, n_chars, text)
        claim = own
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
            lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            claim = brute_leaf(doc_id, source, lang, n_chars, lower)
        order = (doc_id is not None, doc_id or 0, own)
        trees.setdefault((lang is not None, (lang or "").encode()), []).append((order, doc_id, own, claim))
    names = sorted(trees)
    built = {name: brute_tree([r[2] for r in sorted(trees[name])]) for name in names}
    root, tops = brute_tree([built[name][0] for name in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        for (_, doc_id, own, claim), proof in zip(sorted(trees[name]), built[name][1], strict=True):
            fold = claim
            for left, right in [*proof, *top]:
                fold = h(left, fold, right)
            siblings = h(*(x for run in [*proof, *top] for x in run))
            out.append((doc_id, own, built[name][0], root, siblings, fold, fold == root))
    return sorted(out, key=repr)


def report(df):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = merkle.report(df, tampered)
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 63, 65, 4096, 4097])
def test_sweeps_of_one_subtree(n):
    digests = [h(str(i)) for i in range(min(n, merkle.BLOCK))]
    nodes = merkle.upward(digests, merkle.levels_of(len(digests)))
    root, proofs = brute_tree(digests)
    assert nodes[-1] == [root]
    found = dict(merkle.downward(nodes, (("above", ""),)))
    assert [found[i] for i in range(len(digests))] == [(*p, ("above", "")) for p in proofs]


def test_sweeps_follow_the_labels(monkeypatch):
    """Children before parents upward, parents before children downward."""
    popped = []

    def spy(queue):
        popped.append(heapq_pop(queue))
        return popped[-1]

    heapq_pop = heapq.heappop
    monkeypatch.setattr(merkle.heapq, "heappop", spy)
    nodes = merkle.upward([h(str(i)) for i in range(100)], 3)
    assert [p[:2] for p in popped] == sorted(p[:2] for p in popped)
    popped.clear()
    list(merkle.downward(nodes, ()))
    assert [p[:2] for p in popped] == sorted(p[:2] for p in popped) and popped[0][:2] == (-3, 0)


def test_equals_plain_trees_over_several_rounds(spark):
    # One tree needs two rounds, others are a leaf, a run, and a run and one.
    langs = ["x"] * 4200 + ["one"] + ["eight"] * 8 + ["nine"] * 9 + [None] * 70 + ["é", "z"]
    rows = [(i * 7 % 5003, f"Text {i} É", lang, None if i % 5 else "s", i) for i, lang in enumerate(langs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert report(df) == brute_report(rows)


def test_defined_cases(odd, none):
    assert report(odd) == brute_report(odd_rows())
    assert report(none) == []


def test_a_row_repeated_many_times(spark):
    rows = [(5, "same", "en", "s", 4)] * 3000 + [(i, "other", "en", "s", 4) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert report(df.repartition(6)) == brute_report(rows)
    sizes = merkle.placed(df.select(F.lit("").alias("tree"), "doc_id", merkle.leaf().alias("digest")), ["doc_id", "digest"])
    assert sorted(r["idx"] for r in sizes.collect()) == list(range(len(rows)))


def test_lone_leaf(spark):
    df = spark.createDataFrame([(3, "Aa", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = merkle.manifest(df).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof"] == []


def test_any_change_is_seen(spark):
    rows = [(i, f"t{i}", "en", "s", 2) for i in range(50)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema)
    for column in ("source", "lang", "n_chars", "text"):
        changed = merkle.leaf(**{column: F.lit("7") if column != "n_chars" else F.lit(7)})
        found = merkle.manifest(df, changed).select(merkle.folded(F.col("claim"), F.col("proof")).alias("f"), "root")
        assert found.where("f = root").count() == 0

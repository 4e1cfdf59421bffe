"""Spelling variants of a corpus's words: PartEnum signatures, an equi-join and a check.

A word's letters are a multiset, and a multiset is a binary vector with one place per letter
and repetition.  One replaced letter moves the vector by a Hamming distance of two, one
inserted or deleted letter by one.  PartEnum deals the places into groups (by letter), and lists
all choices of as many groups as may stay equal: two vectors within distance two differ in at
most two of ``GROUPS_EQUAL`` groups, vectors within distance one in at most one of
``GROUPS_OTHER``.  A signature is a digest of one choice with its letters, and of the length
the pair must have; so near words share a signature for certain.  Words that share one are
joined on it and checked exactly inside the join; only near pairs leave it.

Signatures of more than ``CROWDED`` words are not joined.  Their words are keyed once more by
the word with each of its letters left out (marked for replacements): near words agree on
such a key, and at most one word per letter of the alphabet shares a key of replacements.  A
signature that a third of all words share costs no more than that.  These keys take time
in the square of a word's length, for words of crowded signatures only.

Word counts are summed per task before they are shuffled, by word.  The last form of a word is
found by doubling: every round joins the words whose pointer can still move with the pointers,
so chains of n forms take log n rounds, each written to the shared folder.  A form has
twice the count of its word, so chains have at most 63 links.

Defined cases: null texts have no words; rows without an id count as id "" in the checksum
that decides on deletions; a repeated row counts again; texts and runs of any length are
taken whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstream.llm.common import written

LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LETTERS, LEAST_COUNT = 5, 3
# A run loses a letter where this divides its checksum.
ERROR_MODULUS = 97
# A form occurs so many times as often as the word.
FORM_RATIO = 2
# Groups of letters for pairs of equal length (two groups may differ) and others (one may).
GROUPS_EQUAL, GROUPS_OTHER = 7, 5
CROWDED = 512
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def misspelt(doc_id: Column, run: Column) -> Column:
    """The run, without one letter where the checksum of id and run says so."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    h = F.crc32(key.cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % ERROR_MODULUS == 0, cut).otherwise(run)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: words of at least five letters and three occurrences."""
    # A shorter run cannot become a word.
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"({LETTERS}{{{LEAST_LETTERS},}})"), F.lit(1))
    found = docs.select("doc_id", F.explode(runs).alias("run"))
    lower = F.translate("run", _UPPER, _LOWER)
    said = found.select("doc_id", lower.alias("run")).select(misspelt(F.col("doc_id"), F.col("run")).alias("word"))
    return (
        said.groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") >= LEAST_COUNT) & (F.char_length("word") >= LEAST_LETTERS))
    )


# --- signatures


def _groups(letters: Column, n: int) -> list[Column]:
    """The sorted letters of each of ``n`` groups."""

    def group(g: int) -> Column:
        return F.array_join(F.filter(letters, lambda x: F.pmod(F.ascii(x), F.lit(n)) == g), "")

    return [group(g) for g in range(n)]


def _chosen(groups: str, n: int, differ: int, length: Column, family: int) -> list[Column]:
    return [
        F.xxhash64(F.lit(family), F.lit(i), length, *(F.col(groups)[g] for g in kept))
        for i, kept in enumerate(combinations(range(n), n - differ))
    ]


def signatures(counted: DataFrame) -> DataFrame:
    """``sig, role, word, n``: role 0 pairs with 0 (equal length), 1 (shorter) with 2 (longer)."""
    letters = F.array_sort(F.split("word", ""))
    grouped = counted.select("word", "n", letters.alias("letters")).select(
        "word",
        "n",
        F.char_length("word").alias("size"),
        F.array(*_groups(F.col("letters"), GROUPS_EQUAL)).alias("equal"),
        F.array(*_groups(F.col("letters"), GROUPS_OTHER)).alias("other"),
    )
    size = F.col("size")
    sets = [
        (0, _chosen("equal", GROUPS_EQUAL, 2, size, 0)),
        (1, _chosen("other", GROUPS_OTHER, 1, size, 1)),
        (2, _chosen("other", GROUPS_OTHER, 1, size - 1, 1)),
    ]
    made = [F.struct(s.alias("sig"), F.lit(role).alias("role")) for role, sigs in sets for s in sigs]
    return grouped.select(F.inline(F.array(*made)), "word", "n")


def left_out(words: DataFrame) -> DataFrame:
    """``sig, role, word, n``: keys of a word with each of its letters left out."""
    at = F.explode(F.sequence(F.lit(1), F.char_length("word"))).alias("at")
    size = F.char_length("word")
    before = F.substring(F.col("word"), F.lit(1), F.col("at") - 1)
    after = F.substring(F.col("word"), F.col("at") + 1, size)
    each = words.select("word", "n", at).select(
        "word",
        "n",
        F.inline(
            F.array(
                F.struct(F.xxhash64(F.lit(2), F.col("at"), before, after).alias("sig"), F.lit(0).alias("role")),
                F.struct(F.xxhash64(F.lit(3), F.concat(before, after)).alias("sig"), F.lit(2).alias("role")),
            )
        ),
    )
    whole = words.select("word", "n", F.xxhash64(F.lit(3), F.col("word")).alias("sig"), F.lit(1).alias("role"))
    # A letter within a run of equal ones gives the same key for each of them.
    return each.select("sig", "role", "word", "n").distinct().unionByName(whole)


def _near(keys: DataFrame) -> DataFrame:
    """Near pairs among the words that share a key."""
    a = keys.select("sig", *(F.col(c).alias(f"a_{c}") for c in ("role", "word", "n")))
    b = keys.select("sig", *(F.col(c).alias(f"b_{c}") for c in ("role", "word", "n")))
    fits = ((F.col("a_role") == 0) & (F.col("b_role") == 0) & (F.col("a_word") < F.col("b_word"))) | (
        (F.col("a_role") == 1) & (F.col("b_role") == 2)
    )
    near = F.levenshtein(F.col("a_word"), F.col("b_word"), 1) == 1
    return a.join(b, (a["sig"] == b["sig"]) & fits & near).select("a_word", "a_n", "b_word", "b_n")


def near_pairs(counted: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``a_word, a_n, b_word, b_n`` of every two near words, once."""
    keys = written(signatures(counted), "spelling-signatures")
    many = written(
        keys.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > crowded).select("sig"), "spelling-crowded"
    )
    few = _near(keys.join(many, "sig", "left_anti"))
    rest = keys.join(many, "sig", "left_semi").select("word", "n").distinct()
    return few.unionByName(_near(left_out(rest))).distinct()


# --- forms


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word that has a form: the last of its chain of forms."""
    state = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moves")), "spelling-roots")
    while not state.where("moves").isEmpty():
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = state.where("moves").join(further, "root", "left")
        stepped = moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moves"))
        state = written(state.where("not moves").unionByName(stepped), "spelling-roots")
    return state.drop("moves")


def variants(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the corpus."""
    counted = written(word_counts(docs), "spelling-words")
    pairs = near_pairs(counted, crowded)

    def side(a: str, b: str) -> Column:
        return F.struct(*(F.col(f"{x}_{c}").alias(f"{y}{c}") for x, y in ((a, ""), (b, "near_")) for c in ("word", "n")))

    both = pairs.select(F.inline(F.array(side("a", "b"), side("b", "a"))))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near_word"))
    found = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= FORM_RATIO * F.col("n")
    judged = written(
        found.select(
            "word",
            "n_near",
            F.when(is_form, F.col("best.near_word")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(judged.where("form is not null"))
    return (
        counted.join(judged, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            "form_n",
        )
    )

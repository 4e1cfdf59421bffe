"""Quality rules: a table of thresholds compiled into one projection.

Every rule compares a ratio of two measures with a bound.  The measures are built-in
functions of the text, so a document is judged where it is read: no shuffle, no user
function.

Defined cases: a null or empty text has no words, no lines and fails; a document without
the measure below a ratio (no words, no lines) counts as one; repeated rows are judged
each on its own; null ids are kept; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstream.functions.rows import computed_once
from fleetstream.llm.common import words

SYMBOLS = "[#*$%&|<>]"
WORD_LINE = r"[^\x20\x09-\x0D]"

# Common words of the four languages of the documents.
STOP_WORDS = (
    "the be to of and that have with in is it for on as was this are by from "
    "de la que el en los las un una del se con por para su es no "
    "der die das den von zu mit sich des auf für ist im nicht ein eine als auch und "
    "le les et du est qui dans pour sur au pas avec"
).split()


@dataclass(frozen=True)
class Rule:
    """``numerator / denominator`` must lie between the bounds (both included)."""

    name: str
    numerator: str
    denominator: str | None = None
    least: float | None = None
    most: float | None = None

    def passed(self) -> Column:
        below = F.greatest(F.col(self.denominator), F.lit(1)) if self.denominator else F.lit(1)
        tests = []
        if self.least is not None:
            tests.append(F.col(self.numerator) >= F.lit(self.least) * below)
        if self.most is not None:
            tests.append(F.col(self.numerator) <= F.lit(self.most) * below)
        return reduce(lambda a, b: a & b, tests)


BASE_RULES = (
    Rule("words", "n_words", least=50),
    Rule("repeated_windows", "n_repeat_words", "n_words", most=0.5),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", least=2.0, most=12.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("shouting", "n_exclamations", "n_words", most=0.2),
    Rule("same_lines", "n_dup_lines", "n_lines", most=0.4),
    Rule("stop_words", "n_stop_words", "n_words", least=0.01),
)


def covered_by_repeats(w: Column, window: int = 3) -> Column:
    """Words inside a window of ``window`` words that the array holds twice or more.

    Windows are compared by a 64-bit digest.  Only texts with a repeated digest are
    sorted with positions; in those, neighbours in the sorted order tell the repeats.
    """
    last = F.size(w) - window + 1

    def digest(i):
        return F.xxhash64(*(F.element_at(w, (i + k).cast("int")) for k in range(window)))

    digests = F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), digest)).otherwise(
        F.array().cast("array<bigint>")
    )
    repeated = F.size(F.array_distinct(digests)) < last

    placed = F.array_sort(
        F.transform(digests, lambda d, i: F.struct(d.alias("d"), i.cast("int").alias("i")))
    )

    def starts(sorted_windows):
        def same(x, i, step):
            at = i + step
            inside = (at >= 0) & (at < F.size(sorted_windows))
            return inside & (F.get(sorted_windows, at)["d"] == x["d"])

        return F.sort_array(
            F.transform(
                F.filter(sorted_windows, lambda x, i: same(x, i, -1) | same(x, i, 1)),
                lambda x: x["i"],
            )
        )

    def covered(s):
        # The last window counts whole, every other up to the start of the next.
        step = F.transform(
            s, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(s, i + 1) - x, F.lit(window)))
        )
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def bound(value, use):
        # A one-element transform evaluates the value once for all its uses.
        return F.element_at(F.transform(F.array(value), use), 1)

    return F.when(repeated, bound(bound(placed, starts), covered)).otherwise(F.lit(0)).cast("bigint")


def measures(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The counts that rules refer to, one row per document."""
    t = F.coalesce(F.col(text), F.lit(""))
    split = computed_once(
        docs.select(*keep, t.alias("_text")),
        {
            "_words": words(F.col("_text")),
            "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD_LINE)),
        },
        [*keep, "_text"],
    )
    w, lines, t = F.col("_words"), F.col("_lines"), F.col("_text")
    stop = list(dict.fromkeys(STOP_WORDS))
    return computed_once(
        split,
        {
            "n_words": F.size(w).cast("bigint"),
            "word_chars": F.aggregate(w, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)),
            "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("bigint"),
            "n_exclamations": F.regexp_count(t, F.lit("!")).cast("bigint"),
            "n_lines": F.size(lines).cast("bigint"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
            "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(stop))).cast(
                "bigint"
            ),
            "n_repeat_words": covered_by_repeats(w),
        },
        list(keep),
    )


def judged(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    base: Sequence[Rule] = BASE_RULES,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Measures with ``base_failed``, ``kept`` and the names of the ``failed`` rules."""
    every = [*base, *rules]
    all_of = lambda chosen: reduce(lambda a, b: a & b, (r.passed() for r in chosen), F.lit(True))
    names = F.array_compact(F.array(*(F.when(~r.passed(), F.lit(r.name)) for r in every)))
    return measures(docs, keep).select(
        "*", (~all_of(base)).alias("base_failed"), all_of(every).alias("kept"), names.alias("failed")
    )

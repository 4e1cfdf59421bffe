"""Secret scan over a trigram inverted index.

Every rule's regular expression is turned into a Boolean query over trigrams that any
match must contain.  The index holds, per trigram that some query names, the documents
whose lower-cased text contains it; the postings are intersected and united as the query
says, and only the candidates are scanned with the expression.  A rule whose expression
has no mandatory trigram scans all documents.  All of it is DataFrame functions.

Defined cases: null and empty texts have no spans; null ids are kept; equal rows share
one posting and each gets the spans; other columns are ignored; an empty table gives an
empty result.  Positions are code points, the end is exclusive.  A text of any length and with
any number of matches is scanned whole, in steps that grow with n log n.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as rx
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstream.functions.rows import computed_once
from fleetstream.llm.common import packed, row_key

GRAM = 3
# Alternatives of one sub-expression beyond which it counts as unknown text.
MOST_ALTERNATIVES = 64
# Code points per block of a text that is masked.
BLOCK = 4096


@dataclass(frozen=True)
class Rule:
    """A kind of secret: the expression, and the least length of one of its groups."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    base: bool = False


# The three base kinds and their least lengths.
BASE = (
    Rule(
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        12,
        group=2,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 18, base=True),
    # Shorter runs fail the length anyway, so they need not be listed.
    Rule("hex", r"[0-9a-f]{16,}", 16, base=True),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 27),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 30),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}", 39),
    Rule("bearer", r"(?i:authorization)\x20*:\x20*(?i:bearer)\x20+[A-Za-z0-9._~+/-]{16,}", 40),
)
RULES = BASE + ADDED


# --- from an expression to its trigram query: a set of alternatives, each a set of trigrams


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + GRAM] for i in range(len(text) - GRAM + 1))


def _strings(items) -> set[str] | None:
    """All texts, lower-cased, that a parsed sequence can match; None if not a small set."""
    found = {""}
    for op, value in items:
        if op is rx.LITERAL:
            part = {chr(value).lower()}
        elif op is rx.SUBPATTERN:
            part = _strings(value[-1])
        elif op is rx.BRANCH:
            branches = [_strings(b) for b in value[1]]
            part = None if None in branches else set().union(*branches)
        elif op is rx.IN and all(o is rx.LITERAL for o, _ in value):
            part = {chr(v).lower() for _, v in value}
        elif op is rx.MAX_REPEAT and value[1] is not rx.MAXREPEAT and value[1] <= 4:
            once = _strings(value[2])
            part = once and {
                "".join(x) for n in range(value[0], value[1] + 1) for x in product(once, repeat=n)
            }
        else:
            part = None
        if part is None or len(part) * len(found) > MOST_ALTERNATIVES:
            return None
        found = {a + b for a in found for b in part}
    return found


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """A conjunction of clauses; a clause is met if all trigrams of one alternative occur.

    Empty if no trigram is mandatory.
    """
    clauses: list[list[frozenset[str]]] = []

    def flush(texts: set[str]) -> None:
        if texts and all(len(t) >= GRAM for t in texts):
            alternatives = {_grams(t) for t in texts}
            # An alternative that asks for more than another one adds nothing.
            least = [a for a in alternatives if not any(b < a for b in alternatives)]
            clauses.append(sorted(least, key=sorted))

    def walk(items) -> None:
        run = {""}
        for item in items:
            part = _strings([item])
            if part is not None and len(run) * len(part) <= MOST_ALTERNATIVES:
                run = {a + b for a in run for b in part}
                continue
            flush(run)
            run = {""}
            op, value = item
            if op is rx.SUBPATTERN:
                walk(value[-1])
            elif op is rx.MAX_REPEAT and value[0] >= 1:
                walk(value[2])
        flush(run)

    walk(regex_parser.parse(pattern))
    return clauses


# --- the index


def postings(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """``trigram, key``: which rows (see ``row_key``) contain which of the trigrams."""
    present = F.filter(F.array(*map(F.lit, trigrams)), lambda g: F.contains(F.col("_low"), g))
    low = computed_once(
        docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "text"),
        {"_low": F.lower("text")},
        ["key"],
    )
    return low.select("key", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``key, rules``: the rules whose query the postings of a row satisfy."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    names = sorted({g for q in queries.values() for clause in q for alt in clause for g in alt})
    bit = {g: i for i, g in enumerate(names)}

    def mask(grams) -> list[int]:
        out = [0] * (len(names) // 62 + 1)
        for g in grams:
            out[bit[g] // 62] |= 1 << bit[g] % 62
        return out

    def met(alternative) -> Column:
        tests = [
            F.col(f"_m{i}").bitwiseAND(F.lit(m)) == F.lit(m)
            for i, m in enumerate(mask(alternative))
            if m
        ]
        return reduce(lambda a, b: a & b, tests)

    at = F.create_map(*(F.lit(x) for g in names for x in (g, bit[g])))
    place = index.select("key", F.element_at(at, F.col("trigram")).alias("_bit"))
    masks = place.groupBy("key").agg(
        *(
            F.bit_or(
                F.when(
                    F.floor(F.col("_bit") / 62) == i,
                    F.expr(f"shiftleft(1L, _bit - {62 * i})"),
                ).otherwise(F.lit(0).cast("bigint"))
            ).alias(f"_m{i}")
            for i in range(len(names) // 62 + 1)
        )
    )
    fits = {
        kind: reduce(
            lambda a, b: a & b, (reduce(lambda a, b: a | b, map(met, clause)) for clause in query)
        )
        for kind, query in queries.items()
    }
    chosen = F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in fits.items())))
    return masks.select("key", chosen.alias("rules")).where(F.size("rules") > 0)


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Matches of the rule from left to right that are long enough, with their positions.

    The text is split at the matches; the lengths of the pieces and of the matches add up
    to the positions.
    """
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    gaps = F.transform(F.slice(between, 1, F.size(whole)), F.length)
    lengths = F.transform(whole, F.length)
    ends = accumulated(F.zip_with(gaps, lengths, lambda gap, length: gap + length), lambda a, b: a + b)
    matches = F.arrays_zip(
        lengths.alias("length"), F.transform(checked, F.length).alias("checked"), ends.alias("end")
    )
    return F.transform(
        F.filter(matches, lambda x: x["checked"] >= rule.least),
        lambda x: F.struct(
            (x["end"] - x["length"]).alias("start"),
            F.lit(order).alias("ord"),
            F.lit(rule.kind).alias("kind"),
            x["end"].alias("end"),
        ),
    )


def accumulated(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """Every value merged with all before it, in passes that double the reach: n log n steps."""
    passes = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))

    def doubled(state: Column, k: Column) -> Column:
        reach = F.pow(F.lit(2), k).cast("int")

        def step(x: Column, i: Column) -> Column:
            before = F.get(state, i - reach)
            return F.when(before.isNull(), x).otherwise(merge(before, x))

        return F.transform(state, step)

    return F.aggregate(passes, values, doubled)


def secret_spans(docs: DataFrame, rules: Sequence[Rule] = RULES, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, and ``found``: array of start, ord, kind, end by start and order of rules."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    names = sorted({g for q in queries.values() for clause in q for alt in clause for g in alt})
    rows = docs.select(
        F.struct(*keep).alias("_kept"),
        F.coalesce("text", F.lit("")).alias("_text"),
        row_key(F.col("doc_id"), F.col("text")).alias("key"),
    )
    found = candidates(postings(docs, names), rules)
    joined = rows.join(found, "key", "left")
    empty = F.array().cast("array<struct<start:int,ord:int,kind:string,end:int>>")

    def scanned(rule: Rule, order: int) -> Column:
        text = F.col("_text")
        wanted = text.rlike(rule.pattern)
        if queries[rule.kind]:
            wanted = F.coalesce(F.array_contains("rules", rule.kind), F.lit(False)) & wanted
        return F.when(wanted, spans_of(text, rule, order)).otherwise(empty)

    every = F.array_sort(F.concat(*(scanned(r, i) for i, r in enumerate(rules))))
    spread = computed_once(joined, {"found": every}, ["_kept"])
    return spread.select(*(F.col("_kept")[c].alias(c) for c in keep), "found")


def rendered(found: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(
        F.transform(
            found,
            lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")),
        ),
        ",",
    )


def scan(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans per document."""
    base = [r.kind for r in BASE]
    found = secret_spans(docs)
    in_base = F.filter("found", lambda x: x["kind"].isin(base))

    def counted(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [counted(kind) for kind in base]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(rendered(in_base).cast("binary"), 256).alias("base_sha256"),
        rendered(F.col("found")).alias("spans"),
    )


def masked(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The documents with every found span replaced by ``mark`` and n_chars counted again."""
    found = secret_spans(packed(docs), keep=["_row"])
    text = F.coalesce(F.col("_row")["text"], F.lit(""))
    hit = F.size("found") > 0
    reached = accumulated(F.transform("found", lambda x: x["end"]), lambda a, b: F.greatest(a, b))
    cut = computed_once(
        found,
        {
            # A position inside the text is looked up in its block, not counted from the start.
            "_blocks": F.when(hit, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))),
            "_reached": F.when(hit, reached),
            "_length": F.when(hit, F.length(text)),
        },
        ["_row", "found"],
    )
    ends, last = F.col("_reached"), F.element_at("_reached", -1)

    def part(start: Column, end: Column) -> Column:
        first = F.floor(start / BLOCK).cast("int")
        number = F.floor((end - 1) / BLOCK).cast("int") - first + 1
        blocks = F.array_join(F.slice("_blocks", first + 1, F.greatest(number, F.lit(0))), "")
        return F.when(end > start, F.substring(blocks, start - first * BLOCK + 1, end - start)).otherwise("")

    # Overlapping spans become one; the text between spans is kept.
    before = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1))
    pieces = F.zip_with(
        "found",
        before,
        lambda x, at: F.when(x["start"] >= at, F.concat(part(at, x["start"]), F.lit(mark))).otherwise(""),
    )
    clean = F.when(F.col("_length").isNotNull(), F.concat(F.array_join(pieces, ""), part(last, F.col("_length"))))
    made = computed_once(cut, {"_clean": clean}, ["_row"])
    changed = F.col("_clean").isNotNull()

    def column(name: str) -> Column:
        old = F.col("_row")[name]
        if name == "text":
            return F.coalesce("_clean", old).alias(name)
        if name == "n_chars":
            return F.when(changed, F.length("_clean").cast("bigint")).otherwise(old).alias(name)
        return old.alias(name)

    return made.select(*map(column, docs.columns))

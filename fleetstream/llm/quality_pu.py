"""Quality classifier learnt from trusted positives and unlabelled text.

The score is logistic over an additive model: every measure of a text falls into a
quantile bin, and every bin has a weight.  The weights minimise the non-negative unbiased
risk of positive-unlabelled learning, with the logistic loss,

    prior * risk(positives, as good) + max(0, risk(unlabelled, as bad) - prior * risk(positives, as bad)),

so labels of bad documents are never needed.  The class prior is estimated from the same
two sets: it is the least ratio of unlabelled to positive mass above a threshold of a
classifier that tells the two sets apart.  At last the scores are calibrated on the same sets:
in every quantile bin of the raw score the share of good rows is the prior times the ratio of
positive to unlabelled mass, and a slope and an offset are fitted to these shares.

Measures are built-in functions, computed once for every whole text; the fit runs on the
driver over two samples of at most ``MOST_ROWS`` rows each (documented bound).  A count gives
the largest digest that a sampled row may have, so tasks send only rows that are likely to be
taken, however many partitions there are; of these the ones with the smallest digests are
taken.  Rows of one id with equal measures count once in a sample.  Scoring is one projection.

Defined cases: a null or empty text has all measures 0 and gets the score of that point;
null ids are scored, and are held out only if the remainder of an empty id says so;
repeated rows get equal scores; labels whose id has no document are ignored; without
positives the score is the constant ``UNKNOWN``; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstream.functions.rows import computed_once
from fleetstream.llm.common import packed, words, written
from fleetstream.llm.rules import STOP_WORDS, SYMBOLS, WORD_LINE

MOST_ROWS = 20_000
# Rows sent to the driver for a sample, relative to its size: enough that too few are unlikely.
# The counts that decide on it have this relative error.
SPARE, PRECISION = 1.1, 0.02
# Quantile bins per measure (fewer if there are few rows) and further edges in the tails.
BINS = 16
TAILS = (0.02, 0.05, 0.95, 0.98)
RIDGE = 0.01
STEPS = 400
THRESHOLD = 0.3
# Bins of the raw score for the calibration.
SHARES = 64
UNKNOWN = 0.5
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether the id's checksum keeps the row out of learning."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def measured(docs: DataFrame, keep=("doc_id",)) -> DataFrame:
    """``keep`` and ``x``, the array of measures of each whole text."""
    text = F.coalesce("text", F.lit(""))
    split = computed_once(
        docs.select(*keep, text.alias("_text")),
        {
            "_words": words(F.col("_text")),
            "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD_LINE)),
        },
        [*keep, "_text"],
    )
    w, lines, t = F.col("_words"), F.col("_lines"), F.col("_text")
    counted = computed_once(
        split,
        {
            "words": F.size(w),
            "distinct": F.size(F.array_distinct(w)),
            "chars": F.length(t),
            "lines": F.size(lines),
            "same_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "symbols": F.regexp_count(t, F.lit(SYMBOLS)),
            "marks": F.regexp_count(t, F.lit("[!?]")),
            "capitals": F.regexp_count(t, F.lit(r"\p{Lu}")),
            "digits": F.regexp_count(t, F.lit("[0-9]")),
            "stops": F.size(F.filter(w, lambda x: F.lower(x).isin(list(dict.fromkeys(STOP_WORDS))))),
            "same_next": F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))),
            "alone": F.size(F.filter(w, lambda x: F.length(x) == 1)),
        },
        list(keep),
    )
    n, chars, k = (F.greatest(F.col(c), F.lit(1)) for c in ("words", "chars", "lines"))
    return counted.select(
        *keep,
        F.array(
            F.log1p(F.col("words")),
            F.col("distinct") / n,
            (F.col("distinct") / n) * F.log1p(F.col("words")),
            F.col("chars") / n,
            F.col("words") / k,
            F.col("same_lines") / k,
            F.col("symbols") / n,
            F.col("marks") / n,
            F.col("capitals") / chars,
            F.col("digits") / chars,
            F.col("stops") / n,
            F.col("same_next") / n,
            F.col("alone") / n,
        ).alias("x"),
    )


@dataclass(frozen=True)
class Model:
    """Bin edges and bin weights per measure."""

    edges: list[list[float]]
    weights: list[list[float]]
    bias: float
    prior: float

    def score(self, x: Column) -> Column:
        """The probability of a good document, from the array of measures."""
        total = F.lit(self.bias)
        for i, (cuts, weights) in enumerate(zip(self.edges, self.weights, strict=True)):
            value = F.get(x, F.lit(i))
            # Widening halves: a balanced tree of comparisons per measure.
            total = total + _tree(value, cuts, weights)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _tree(value: Column, cuts: list[float], weights: list[float]) -> Column:
    if not cuts:
        return F.lit(float(weights[0]))
    mid = len(cuts) // 2
    return F.when(value < F.lit(cuts[mid]), _tree(value, cuts[:mid], weights[: mid + 1])).otherwise(
        _tree(value, cuts[mid + 1 :], weights[mid + 1 :])
    )


def _one_hot(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    out = []
    for i, cuts in enumerate(edges):
        bins = np.searchsorted(cuts, x[:, i], side="right")
        out.append(np.eye(len(cuts) + 1, dtype=np.float32)[bins])
    return np.concatenate(out, axis=1)


def _loss(margin):
    """The logistic loss of a margin and its derivative."""
    return np.logaddexp(0, -margin), -1 / (1 + np.exp(np.clip(margin, -30, 30)))


def _descend(gradient, size: int) -> np.ndarray:
    """Adam over all rows."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, STEPS + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


def _decay(rows: int, size: int) -> np.ndarray:
    """Penalty on every weight but the bias, weaker the more rows there are."""
    decay = np.full(size, RIDGE / rows)
    decay[-1] = 0
    return decay


def estimated_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives among the unlabelled rows.

    Each half of the rows is judged by a classifier of positive against unlabelled that was
    fitted on the other half.
    """
    scores: list[tuple[np.ndarray, np.ndarray]] = []
    for half in (0, 1):
        fit_p, fit_u, on_p, on_u = p[half::2], u[half::2], p[1 - half :: 2], u[1 - half :: 2]
        if not min(map(len, (fit_p, fit_u, on_p, on_u))):
            continue
        decay = _decay(len(fit_p), p.shape[1])

        def gradient(w, fit_p=fit_p, fit_u=fit_u, decay=decay):
            gp, gu = _loss(fit_p @ w)[1] / len(fit_p), -_loss(-(fit_u @ w))[1] / len(fit_u)
            return fit_p.T @ gp + fit_u.T @ gu + decay * w

        w = _descend(gradient, p.shape[1])
        scores.append((on_p @ w, on_u @ w))
    if not scores:
        return UNKNOWN
    ratios = []
    for level in (0.03, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5):
        # Mass above the same share of positives in both halves.
        parts = [(np.mean(sp >= (c := np.quantile(sp, level))), np.mean(su >= c)) for sp, su in scores]
        ratios.append(np.mean([x[1] for x in parts]) / np.mean([x[0] for x in parts]))
    return float(np.clip(min(ratios), 0.05, 0.98))


def calibration(on_p: np.ndarray, on_u: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and offset that turn raw scores of both sets into log odds of a good row."""
    cuts = np.unique(np.quantile(on_u, np.linspace(0, 1, SHARES + 1)[1:-1]))
    bin_p, bin_u = (np.searchsorted(cuts, m, side="right") for m in (on_p, on_u))
    mass_p, mass_u = (np.bincount(b, minlength=len(cuts) + 1) / len(b) for b in (bin_p, bin_u))
    share = np.clip(prior * mass_p / np.maximum(mass_u, 1 / len(on_u)), 0, 1)[bin_u]
    middle, spread = on_u.mean(), on_u.std() or 1.0
    z = np.stack([(on_u - middle) / spread, np.ones(len(on_u))], axis=1)

    def gradient(w):
        return z.T @ (1 / (1 + np.exp(-np.clip(z @ w, -30, 30))) - share) / len(z)

    slope, offset = _descend(gradient, 2)
    # Scores keep their order whatever the bins say.
    slope = max(slope, 0.1) / spread
    return float(slope), float(offset - slope * middle)


def fitted(positives: np.ndarray, unlabelled: np.ndarray) -> Model:
    """The model of least non-negative risk over two arrays of measures."""
    edges = []
    for i in range(unlabelled.shape[1]):
        both = np.concatenate([positives[:, i], unlabelled[:, i]])
        bins = int(np.clip(len(positives) // 40, 4, BINS))
        cuts = np.quantile(both, np.concatenate([np.linspace(0, 1, bins + 1)[1:-1], TAILS]))
        edges.append([float(c) for c in np.unique(cuts) if c > both.min()])
    p, u = (
        np.concatenate([_one_hot(z, edges), np.ones((len(z), 1), np.float32)], axis=1)
        for z in (positives, unlabelled)
    )
    prior = estimated_prior(p, u)
    decay = _decay(len(p), p.shape[1])

    def gradient(w):
        fp, fu = p @ w, u @ w
        good, d_good = _loss(fp)
        bad_p, d_bad_p = _loss(-fp)
        bad_u, d_bad_u = _loss(-fu)
        rest = bad_u.mean() - prior * bad_p.mean()
        of_rest = u.T @ (-d_bad_u / len(u)) - prior * (p.T @ (-d_bad_p / len(p)))
        if rest < 0:  # the negative risk cannot be negative: step back out of it
            return -of_rest + decay * w
        return prior * (p.T @ (d_good / len(p))) + of_rest + decay * w

    w = _descend(gradient, p.shape[1])
    slope, offset = calibration(p @ w, u @ w, prior)
    w = w * slope
    w[-1] += offset
    weights, at = [], 0
    for cuts in edges:
        weights.append([float(x) for x in w[at : at + len(cuts) + 1]])
        at += len(cuts) + 1
    return Model(edges, weights, float(w[-1]), prior)


def learnt(measures: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on rows that are not held out: labelled good ones, and any as unlabelled."""
    trusted = labels.where("quality = 1").select("doc_id").distinct().withColumn("good", F.lit(True))
    digest = F.xxhash64("doc_id", "x").alias("d")
    usable = measures.where(~held_out(F.col("doc_id"))).join(trusted, "doc_id", "left").select("x", digest, "good")
    is_good = F.col("good").isNotNull()
    rows, good = usable.agg(
        F.approx_count_distinct("d", PRECISION), F.approx_count_distinct(F.when(is_good, F.col("d")), PRECISION)
    ).first()

    def limit(n: int) -> int:
        """The largest digest of the rows to send, digests being spread evenly."""
        share = min(1.0, SPARE * MOST_ROWS / max(n, 1))
        return min(int(share * 2.0**64) - (1 << 63), (1 << 63) - 1)

    of_good, of_all = limit(good), limit(rows)
    sent = usable.where((is_good & (F.col("d") <= of_good)) | (F.col("d") <= of_all))
    found = sorted(sent.groupBy("d", "good").agg(F.any_value("x").alias("x")).collect(), key=lambda r: r["d"])

    def sample(chosen: list) -> np.ndarray:
        return np.array([r["x"] for r in chosen[:MOST_ROWS]], dtype=float)

    positives = sample([r for r in found if r["good"] and r["d"] <= of_good])
    unlabelled = sample([r for r in found if r["d"] <= of_all])
    if not len(positives) or not len(unlabelled):
        return None
    return fitted(positives, unlabelled)


def scored(docs: DataFrame, labels: DataFrame, keep=("doc_id",)) -> DataFrame:
    """``keep``, held_out, score and predicted for every document."""
    measures = written(measured(docs, list(dict.fromkeys(["doc_id", *keep]))), "quality-measures")
    model = learnt(measures.select("doc_id", "x"), labels)
    score = model.score(F.col("x")) if model else F.lit(UNKNOWN)
    once = computed_once(measures, {"score": score}, list(dict.fromkeys(["doc_id", *keep])))
    return once.select(
        *keep,
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with their columns."""
    return scored(packed(docs), labels, ["_row"]).where("predicted = 1").select("_row.*")

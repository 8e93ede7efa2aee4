"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a linear model on shape features by the
non-negative unbiased risk: prior * loss(positives) + max(0, loss of unlabelled as
negatives - prior * loss of positives as negatives). A step that would turn the second part
negative is followed back until it does not. The class prior comes from a first
model that tells positives from unlabelled: the least ratio, over its score thresholds
on held-back rows, of the unlabelled share above to the positive share above.

Every document counts as unlabelled, in the mean and deviation, in the prior and in each
round of the risk. The features are computed once and written; a round of training
is one pass over them, in which each task sums loss, slope and curvature of its rows, and
Newton's method needs few rounds. Where the second part stops the steps short of the least
risk, the last weights before that are kept. Only sums reach the driver, besides the features of about
``positives`` trusted rows, chosen by a hash of id and text.

Results: a null or empty text has zero features and a score like any other. Labels that
contradict each other count as they are: a text is a positive if one row says so.
Without a positive to learn from the score is the prior's default, 0.5.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import quoted, written

POSITIVES = 6_000
ROUNDS, SETTLED = 25, 1e-5
RIDGE = 10.0  # strength of the weights' pull to zero, divided by the positives
SLICE_BYTES = 1 << 20

_KINDS = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" ",
    b"\n",
    b".,;:",
    b"!?",
    b"#*$%&|<>",
    b"'\"()-",
)
_OTHER, _HIGH = len(_KINDS), len(_KINDS) + 1
N_KINDS = len(_KINDS) + 2
_KIND = np.full(256, _OTHER, dtype=np.int64)
_KIND[128:] = _HIGH
for _k, _set in enumerate(_KINDS):
    _KIND[list(_set)] = _k
N_FEATURES = N_KINDS + N_KINDS**2 + 7


def features(text: str | None) -> np.ndarray:
    """Shares of byte kinds and pairs of kinds, and how much words and lines repeat."""
    out = np.zeros(N_FEATURES, dtype=np.float32)
    if not text:
        return out
    body = text.encode("utf-8", "surrogatepass")
    single, pairs = np.zeros(N_KINDS), np.zeros(N_KINDS**2)
    for at in range(0, len(body), SLICE_BYTES):
        kinds = _KIND[np.frombuffer(body, dtype=np.uint8, count=min(SLICE_BYTES + 1, len(body) - at), offset=at)]
        single += np.bincount(kinds[:SLICE_BYTES], minlength=N_KINDS)
        pairs += np.bincount(kinds[:-1] * N_KINDS + kinds[1:], minlength=N_KINDS**2)
    out[:N_KINDS] = single / len(body)
    out[N_KINDS : N_KINDS + N_KINDS**2] = pairs / max(1, len(body) - 1)
    words, lines = text.split(), [line for line in text.split("\n") if line]
    n = max(1, len(words))
    out[-7:] = (
        np.log1p(len(words)) / 10,
        len(set(words)) / n,
        len(set(zip(words, words[1:], words[2:]))) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(body) / n / 20,
        len(set(lines)) / max(1, len(lines)),
        len(lines) / n,
    )
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        value = np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(value, -60, 60)))


#: Sums a measure, which maps rows to so many numbers, over all unlabelled rows.
Sums = Callable[[Callable[[np.ndarray], np.ndarray], int], np.ndarray]


def _sigmoid(value: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(value, -60, 60)))


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def _as_negatives(theta: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Number of rows and, of their loss as negatives, the sum, the slope and the upper half of the curvature."""
    upper = np.triu_indices(len(theta))

    def measure(x: np.ndarray) -> np.ndarray:
        x = _with_one(x)
        value = x @ theta
        share = _sigmoid(value)
        curve = (x * (share * (1 - share))[:, None]).T @ x
        return np.concatenate([[len(x), np.logaddexp(0, value).sum()], share @ x, curve[upper]])

    return measure


def _symmetric(upper: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, n))
    out[np.triu_indices(n)] = upper
    return out + np.triu(out, 1).T


@dataclass
class Point:
    """The risk at some weights, its part that must not be negative, and its slope and curvature."""

    theta: np.ndarray
    risk: float
    negative: float
    slope: np.ndarray
    curve: np.ndarray


def risk_at(theta: np.ndarray, sums: Sums, positive: np.ndarray, alike: float, unalike: float) -> Point:
    """The non-negative risk: ``alike`` * positives as such + max(0, unlabelled - ``unalike`` * positives as negatives).

    ``alike`` = ``unalike`` = prior is the positive-unlabelled risk; 1 and 0 tell the two apart.
    """
    k = len(theta)
    n, loss, *rest = sums(_as_negatives(theta), 2 + k + k * (k + 1) // 2)
    slope_u, curve_u = np.array(rest[:k]) / n, _symmetric(np.array(rest[k:]), k) / n
    x = _with_one(positive)
    value = x @ theta
    share = _sigmoid(value)
    curve_p = (x * (share * (1 - share))[:, None]).T @ x / len(x)
    negative = loss / n - unalike * np.logaddexp(0, value).mean()
    ridge = np.append(np.full(k - 1, RIDGE / len(x)), 1e-9)
    return Point(
        theta,
        alike * np.logaddexp(0, -value).mean() + max(0.0, negative) + (ridge * theta * theta).sum() / 2,
        negative,
        alike * (share - 1) @ x / len(x) + slope_u - unalike * share @ x / len(x) + ridge * theta,
        (alike - unalike) * curve_p + curve_u + np.diag(ridge),
    )


def minimise(sums: Sums, positive: np.ndarray, alike: float, unalike: float) -> np.ndarray:
    """Weights and bias of the least risk, by Newton steps; each round is one pass over the unlabelled rows."""
    at = risk_at(np.zeros(positive.shape[1] + 1), sums, positive, alike, unalike)
    step = -np.linalg.solve(at.curve, at.slope)
    for _ in range(ROUNDS):
        there = risk_at(at.theta + step, sums, positive, alike, unalike)
        if there.risk > at.risk or there.negative < 0:
            step = step / 2  # too far, or into the negative: back towards the last good point
            if np.abs(step).max() < SETTLED:
                break
            continue
        gain, at = at.risk - there.risk, there
        if gain < SETTLED * max(at.risk, SETTLED):
            break
        step = -np.linalg.solve(at.curve, at.slope)
    return at.theta


def _cuts(ps: np.ndarray) -> np.ndarray:
    return np.quantile(ps, np.linspace(0, 0.9, 91))


def _least_ratio(ps: np.ndarray, cuts: np.ndarray, below_u: np.ndarray, n_u: int) -> float:
    """The prior from sorted positive values and the numbers of unlabelled ones below the cuts."""
    above_p = 1 - np.searchsorted(ps, cuts) / len(ps)
    above_u = 1 - below_u / n_u
    slack = np.sqrt(np.log(400) / 2 / len(ps)) + np.sqrt(np.log(400) / 2 / n_u)
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.95))


def prior_of(learn: Sums, held: Sums, positive: np.ndarray, held_positive: np.ndarray) -> float:
    """Share of positives among unlabelled rows, by the best bin of rows held back from the first model."""
    theta = minimise(learn, positive, 1.0, 0.0)
    ps = np.sort(_with_one(held_positive) @ theta)
    cuts = _cuts(ps)

    def below(x: np.ndarray) -> np.ndarray:
        value = np.sort(_with_one(x) @ theta)
        return np.append(np.searchsorted(value, cuts), len(value))

    *counts, n = held(below, len(cuts) + 1)
    return _least_ratio(ps, cuts, np.array(counts), int(n))


def estimate_prior(x: np.ndarray, is_positive: np.ndarray) -> float:
    """The prior from rows in memory, every second of them held back."""
    held = np.arange(len(x)) % 2 == 1

    def over(rows: np.ndarray) -> Sums:
        return lambda measure, _: measure(rows)

    p, q = is_positive & ~held, is_positive & held
    return prior_of(over(x[~is_positive & ~held]), over(x[~is_positive & held]), x[p], x[q])


def _unpacked(packed: list[bytes]) -> np.ndarray:
    return np.array([np.frombuffer(f, dtype=np.float32) for f in packed]).reshape(-1, N_FEATURES)


def _sampled(rows: DataFrame, bound: int) -> np.ndarray:
    """Features of about ``bound`` rows, chosen by the hash of id and text, in its order."""
    share = 1_000_000 * min(1.0, bound / max(1, rows.count()))
    chosen = rows.where(F.pmod(F.col("row"), F.lit(1_000_000)) < share).select("row", "f").collect()
    return _unpacked([r["f"] for r in sorted(chosen)]).astype(np.float64)


def _summed(rows: DataFrame, measure, width: int) -> np.ndarray:
    """The sum over all rows of a measure that maps features to ``width`` numbers."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                total += measure(_unpacked(batch.column(0).slice(at, 4096).to_pylist()).astype(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total)], ["k", "v"])

    summed = rows.select("f").mapInArrow(sums, "k int, v double").groupBy("k").agg(F.sum("v").alias("v"))
    found = summed.toArrow()
    out = np.zeros(width)
    out[found["k"].to_numpy()] = found["v"].to_numpy()
    return out


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each feature over all rows."""

    def measure(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])

    n, *sums = _summed(rows, measure, 1 + 2 * N_FEATURES)
    mean, square = np.array(sums).reshape(2, N_FEATURES) / max(1.0, n)
    return mean, np.sqrt(np.maximum(0.0, square - mean * mean))


def feature_column(text: Column) -> Column:
    """The features as packed 32-bit floats."""

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        return pa.array([features(t.as_py()).tobytes() for t in texts], pa.binary())

    return pack(text)


def featured(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", carry: Sequence[str] = ()
) -> DataFrame:
    """The written features: doc_id, ``carry``, row (a hash of id and text) and f, for every document."""
    return written(
        docs.select(
            quoted(doc_id).alias("doc_id"),
            *map(quoted, carry),
            F.xxhash64(quoted(doc_id), quoted(text)).alias("row"),
            feature_column(quoted(text)).alias("f"),
        ),
        "features",
    )


def fit_features(rows: DataFrame, trusted: DataFrame, *, doc_id: str = "doc_id", positives: int = POSITIVES) -> Model:
    """The model from ``featured`` rows, all of them unlabelled; ``trusted`` has the ids of positives."""
    ids = trusted.select(quoted(doc_id).alias("doc_id")).distinct()
    share = 1_000_000 * min(1.0, 2 * positives / max(1, ids.count()))
    few = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    positive = _sampled(rows.join(few, "doc_id", "left_semi"), positives)
    if len(positive) < 2:
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0, 0.5)
    mean, scale = _moments(rows)
    scale = scale + 1e-3

    def scaled(x: np.ndarray) -> np.ndarray:
        return np.clip((x - mean) / scale, -8, 8)

    def over(part: DataFrame) -> Sums:
        return lambda measure, width: _summed(part, lambda x: measure(scaled(x)), width)

    positive, half = scaled(positive), F.pmod("row", F.lit(2))
    learn, held = over(rows.where(half == 0)), over(rows.where(half == 1))
    shuffled = np.random.default_rng(7).permutation(len(positive))
    cut = (len(positive) + 1) // 2
    prior = 0.5
    if not rows.where(half == 0).isEmpty() and not rows.where(half == 1).isEmpty():
        prior = prior_of(learn, held, positive[shuffled[:cut]], positive[shuffled[cut:]])
    theta = minimise(over(rows), positive, prior, prior)
    return Model(mean, scale, theta[:-1], float(theta[-1]), prior)


def fit(
    docs: DataFrame,
    trusted: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    positives: int = POSITIVES,
) -> Model:
    """``trusted`` has the ids of positives; all documents together are the unlabelled text."""
    rows = featured(docs, text=text, doc_id=doc_id)
    return fit_features(rows, trusted, doc_id=doc_id, positives=positives)


def score_features(docs: DataFrame, model: Model, f: str = "f") -> Column:
    """The probability that a text with these features is of high quality."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(packed: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(_unpacked(packed.to_pylist())), pa.float64())

    return score(quoted(f))


def scored(docs: DataFrame, model: Model, *, text: str = "text") -> Column:
    """The probability that a text is of high quality."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        rows = np.array([features(t.as_py()) for t in texts]).reshape(-1, N_FEATURES)
        return pa.array(shared.value.scores(rows), pa.float64())

    return score(quoted(text))

"""Quality from weak labels: heuristics vote, their accuracies are estimated, a hashed linear scorer learns the outcome.

Each labeller looks at one symptom and votes low (0), high (1) or not at all.
Symptoms overlap, so labellers agree and contradict each other, and
expectation-maximisation over the counts of all vote patterns of all documents
finds how often each is right without a single label. The posterior of a
document's pattern is its weak label. A linear scorer over hashed features of
the text is trained on such labels; it scores every document.
"""

from __future__ import annotations

import functools
import json
import operator
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowline.llm.logistic import sigmoid
from flowline.llm.tables import bounded_sample, documents_of, keep_rows, map_arrow, slices
from flowline.session import cut_lineage

ABSTAIN = -1
#: Documents with weak labels that train the scorer at most, from each side of 0.5.
TRAIN_ROWS = 6_000
#: Buckets of the hashed features.
BUCKETS = 1 << 12
#: A document stays if its score is at least this.
THRESHOLD = 0.5
#: Rounds of expectation-maximisation at most, and the change that ends them.
EM_ROUNDS = 200
EM_CHANGE = 1e-7

# Kinds of characters.
_SPACE, _LOWER, _UPPER, _DIGIT, _MARK, _ODD = range(6)
_KINDS = 6
_COMMON_MARKS = set(".,;:!?'\"()«»„“”’‘-|")


@functools.lru_cache(maxsize=1)
def _kind_table() -> np.ndarray:
    """The kind of each character of the basic plane; those beyond count like its last one, as odd."""
    table = np.full(0x10000, _ODD, np.uint8)
    for code in range(0xFFFF):
        c = chr(code)
        if c.isspace():
            table[code] = _SPACE
        elif c.isupper():
            table[code] = _UPPER
        elif c.isalpha():
            table[code] = _LOWER
        elif c.isdigit():
            table[code] = _DIGIT
        elif c in _COMMON_MARKS:
            table[code] = _MARK
    return table


@dataclass(frozen=True)
class Measures:
    """What the labellers look at: the number of words, and shares of words, characters or lines."""

    words: int
    odd: float
    upper: float
    pipes: float
    repeated_words: float
    repeated_lines: float
    repeated_runs: float
    shouting: float


_SHARES = ("odd", "upper", "pipes", "repeated_words", "repeated_lines", "repeated_runs", "shouting")


def kinds_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return _kind_table()[np.minimum(codes, 0xFFFF)]


def measures(text: str, kinds: np.ndarray) -> Measures:
    own = text.split()
    n = max(1, len(own))
    counts = np.bincount(kinds, minlength=_KINDS)
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    runs = set(zip(own, own[1:], own[2:], own[3:]))
    return Measures(
        words=len(own),
        odd=float(counts[_ODD]) / max(1, len(text)),
        upper=float(counts[_UPPER]) / max(1, int(counts[_UPPER] + counts[_LOWER])),
        pipes=own.count("|") / n,
        repeated_words=sum(map(operator.eq, own, own[1:])) / n,
        repeated_lines=1 - len(set(lines)) / max(1, len(lines)),
        repeated_runs=1 - len(runs) / max(1, len(own) - 3) if runs else 0.0,
        shouting=text.count("!") / n,
    )


def _between(value: float, high_up_to: float, low_from: float) -> int:
    return 1 if value <= high_up_to else 0 if value >= low_from else ABSTAIN


#: Name and vote of each labeller; those with no opinion on short texts say so.
LABELLERS: tuple[tuple[str, Callable[[Measures], int]], ...] = (
    ("odd characters", lambda m: _between(m.odd, 0.01, 0.04)),
    ("capitals", lambda m: _between(m.upper, 0.12, 0.3)),
    ("tables", lambda m: _between(m.pipes, 0.01, 0.1)),
    ("stuttering", lambda m: _between(m.repeated_words, 0.05, 0.2) if m.words >= 8 else ABSTAIN),
    ("repeated lines", lambda m: _between(m.repeated_lines, 0.2, 0.5) if m.words >= 8 else ABSTAIN),
    ("repeated phrases", lambda m: _between(m.repeated_runs, 0.1, 0.4) if m.words >= 20 else ABSTAIN),
    ("exclamations", lambda m: _between(m.shouting, 0.05, 0.3)),
    ("any symptom", lambda m: 0 if max(m.odd * 10, m.upper, m.pipes * 3, m.repeated_words * 2, m.repeated_runs) >= 0.4 else 1),
)


def votes(m: Measures) -> str:
    """The votes in a row, a dash for none."""
    return "".join("-" if v == ABSTAIN else str(v) for v in (vote(m) for _, vote in LABELLERS))


def features(kinds: np.ndarray, m: Measures) -> list[str]:
    """Names of the features before hashing: each measure in steps, and how often each kind of character follows each."""
    names = [f"{name}={_step(getattr(m, name))}" for name in _SHARES]
    names.append(f"size={m.words.bit_length()}")
    pairs = np.bincount(kinds[:-1].astype(np.int64) * _KINDS + kinds[1:], minlength=_KINDS**2)
    steps = (np.sqrt(pairs / max(1, len(kinds) - 1)) * 12).astype(int)
    return names + [f"{at}>{step}" for at, step in enumerate(steps.tolist())]


def _step(share: float) -> int:
    return int(share**0.5 * 12)


@functools.lru_cache(maxsize=100_000)
def _bucket(name: str) -> int:
    return zlib.crc32(name.encode()) % BUCKETS


def hashed(names: list[str]) -> list[int]:
    return sorted(set(map(_bucket, names)))


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents, and per labeller how it votes on bad and on good ones."""

    good: float
    rates: tuple[tuple[tuple[float, float, float], tuple[float, float, float]], ...]

    def accuracies(self) -> dict[str, float]:
        """How often each labeller is right when it votes."""
        out = {}
        for (name, _), (bad, good) in zip(LABELLERS, self.rates):
            right = (1 - self.good) * bad[0] + self.good * good[1]
            voted = (1 - self.good) * (bad[0] + bad[1]) + self.good * (good[0] + good[1])
            out[name] = right / voted if voted else 0.5
        return out

    def posterior(self, pattern: str) -> float:
        """Probability that a document with these votes is good."""
        odds = np.log(self.good) - np.log1p(-self.good)
        for vote, (bad, good) in zip(pattern, self.rates):
            at = "01-".index(vote)
            odds += np.log(good[at]) - np.log(bad[at])
        return float(sigmoid(np.array(odds)))


def estimate(patterns: dict[str, int]) -> LabelModel:
    """Accuracies of the labellers by expectation-maximisation over pattern counts.

    It starts from the share of high votes per pattern, so that 1 means good,
    and keeps each rate a little off 0 and 1. Without patterns every labeller is
    as good as a coin.
    """
    even = ((1 / 3,) * 3,) * 2
    if not patterns:
        return LabelModel(0.5, (even,) * len(LABELLERS))
    names = sorted(patterns)
    n = np.array([patterns[p] for p in names], float)
    seen = np.array([["01-".index(v) for v in p] for p in names])
    is_vote = np.stack([seen == k for k in range(3)], axis=2).astype(float)  # pattern, labeller, vote
    ups, downs = is_vote[:, :, 1].sum(1), is_vote[:, :, 0].sum(1)
    # One low vote is a symptom: it weighs as much as all that is not seen.
    good = np.where(downs == 0, 0.95, np.where(ups + downs > 0, 0.5 * ups / (ups + downs), 0.5))
    model = None
    for _ in range(EM_ROUNDS):
        weight = np.stack([n * (1 - good), n * good])
        rates = np.einsum("cp,plv->lcv", weight, is_vote) + 0.5
        rates /= rates.sum(2, keepdims=True)
        share = float(np.clip(weight[1].sum() / n.sum(), 1e-3, 1 - 1e-3))
        model = LabelModel(share, tuple(tuple(map(tuple, r)) for r in rates.tolist()))
        new = np.array([model.posterior(p) for p in names])
        if np.abs(new - good).max() < EM_CHANGE:
            break
        good = new
    return model


@dataclass(frozen=True)
class Model:
    """The label model, and the weights of the scorer by bucket, the last one its intercept."""

    labels: LabelModel
    weights: dict[int, float]
    intercept: float

    def to_json(self) -> str:
        return json.dumps([self.labels.good, self.labels.rates, sorted(self.weights.items()), self.intercept])


class Scorer:
    def __init__(self, weights: dict[int, float], intercept: float) -> None:
        self.weights, self.intercept = weights, intercept

    def score(self, text: str) -> float:
        kinds = kinds_of(text)
        names = features(kinds, measures(text, kinds))
        return float(sigmoid(np.array(self.intercept + sum(self.weights.get(b, 0.0) for b in hashed(names)))))


@functools.lru_cache(maxsize=2)
def _scorer_of(model: str) -> Scorer:
    _, _, weights, intercept = json.loads(model)
    return Scorer(dict(weights), intercept)


def train_linear(rows: list[list[int]], targets: np.ndarray, rounds: int = 300, rate: float = 0.5) -> tuple[dict[int, float], float]:
    """Logistic regression on sets of buckets against probabilities, by gradient steps over all rows."""
    used = sorted({b for row in rows for b in row})
    if not used:
        return {}, 0.0
    place = {b: k for k, b in enumerate(used)}
    x = np.zeros((len(rows), len(used) + 1))
    x[:, -1] = 1
    for at, row in enumerate(rows):
        x[at, [place[b] for b in row]] = 1
    w, memory = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-8)
    for _ in range(rounds):
        gradient = x.T @ (sigmoid(x @ w) - targets) / len(rows) + 1e-4 * w
        memory += gradient**2
        w -= rate * gradient / np.sqrt(memory)
    return dict(zip(used, w[:-1].tolist())), float(w[-1])


VOTED = T.StructType(
    [T.StructField("pattern", T.StringType()), T.StructField("text_hash", T.LongType())]
    + [T.StructField("buckets", T.ArrayType(T.IntegerType()))]
)
SCORED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])


def fit(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Model:
    """Vote patterns of all documents, their label model, and a scorer trained on TRAIN_ROWS of either side.

    No label is read. Equal texts count as often as they occur in the patterns,
    and train once. There are at most 3 to the number of labellers patterns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            kinds = [kinds_of(t) for t in texts]
            seen = [measures(t, k) for t, k in zip(texts, kinds)]
            buckets = [hashed(features(k, m)) for k, m in zip(kinds, seen)]
            columns = [pa.array([votes(m) for m in seen]), part.column("text_hash"), pa.array(buckets, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, VOTED.names)

    texts = documents_of(df, id_col, text_col).select("text", F.xxhash64("text").alias("text_hash"))
    voted = cut_lineage(map_arrow(texts, run, VOTED), "votes")
    patterns = {r.pattern: r["count"] for r in voted.groupBy("pattern").count().collect()}
    labels = estimate(patterns)
    good = [p for p in patterns if labels.posterior(p) >= 0.5]
    one_each = voted.groupBy("text_hash").agg(F.min("pattern").alias("pattern"), F.min("buckets").alias("buckets"))
    one_each = cut_lineage(one_each, "different-votes")
    is_good = F.col("pattern").isin(good)
    # Different texts are sampled, so these are counted, however often one of them occurs.
    n = {r.good: r["count"] for r in one_each.groupBy(is_good.alias("good")).count().collect()}
    sides = ((is_good, n.get(True, 0)), (~is_good, n.get(False, 0)))
    rows = [r for side, n in sides for r in bounded_sample(one_each.filter(side), TRAIN_ROWS, n, "text_hash").collect()]
    targets = np.array([labels.posterior(r.pattern) for r in rows])
    weights, intercept = train_linear([r.buckets for r in rows], targets)
    return Model(labels, weights, intercept)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: better) per row; null texts count as empty ones."""
    text = model.to_json()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer_of(text)
        for part in slices(batches):
            scores = [scorer.score(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], SCORED.names)

    return map_arrow(documents_of(df, id_col, text_col), run, SCORED)


def of_quality(df: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df``, all columns as they are, that score at least ``threshold``."""
    text = model.to_json()

    def make_keep():
        scorer = _scorer_of(text)
        return lambda texts: [scorer.score(t) >= threshold for t in texts]

    return keep_rows(df, text_col, make_keep)

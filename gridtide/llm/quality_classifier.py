"""Quality classifier: cumulative-link (ordinal) regression on graded ratings.

Every grade shares one weight vector over hashed text features; ordered
thresholds turn a document's score s into P(grade <= k) = sigmoid(threshold_k - s).
From that follow the expected grade and the tail probability P(grade >= g),
by which documents are selected.  The limit of the tail is chosen from the
sample: the highest that keeps ``KEPT_SHARE`` of the documents of the selected
grade, judged by models that have not seen them.

Features are hashes of a document's distinct words, of their endings and of
their shapes (capital, small, digit, mark or other, runs taken together), each
present or not, weighing less the more there are of a kind.  They are computed where the
text is read; scoring is a sum of weights and shuffles nothing.

Grades come from the labels: 0 for low quality, 1 for good but toxic, 2 for
good and clean.  The fit takes at most ``SAMPLE_ROWS`` labelled documents, those
with the lowest hash of the id, as hashed features; their weighted likelihood
is maximised on the driver.  Weights are shipped as a broadcast of fixed size.

A null text has no features and gets the score 0.  Null ids are scored, but not
learned from; repeated rows are scored each; a document labelled twice counts
twice.  Without labelled documents of at least two grades every tail
probability is 1, so all documents are kept.  An empty table gives no rows.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import kept_by_worker

SAMPLE_ROWS = 8_000
FEATURE_BITS = 20
MIN_DOCUMENTS = 5  # a feature of fewer sampled documents has no weight
GRADES = 3
SELECTED_GRADE = 2
KEPT_SHARE = 0.97  # of the selected grade
FOLDS = 4
# Low quality is told by many features; at full weight it leaves the rare grade of the
# toxic, which few words tell, too little room between the thresholds.
GRADE_WEIGHTS = (0.1, 1.0, 1.0)
PENALTY = 0.1
SCALE_POWER = 2.0
ENDING = 3
KINDS = 3
MARKS = string.punctuation.encode()
CACHED_WORDS = 150_000
LONGEST_CACHED = 64  # bytes of a word

_SHAPES = bytes(
    ord("A") if 65 <= n <= 90 else ord("a") if 97 <= n <= 122 or n >= 128 else ord("0")
    if 48 <= n <= 57
    else n
    for n in range(256)
)


def shape(word: bytes) -> bytes:
    """Kinds of characters in a word, runs taken together: ``Word***`` gives ``Aa*``."""
    kinds = word.translate(_SHAPES)
    return bytes(c for n, c in enumerate(kinds) if n == 0 or c != kinds[n - 1])


class TextFeatures:
    """Hashed features of texts; those of a word are kept."""

    def __init__(self, bits: int = FEATURE_BITS) -> None:
        self._mask = (1 << bits) - 1
        self._known: dict[bytes, tuple[int, int, int]] = {}

    def _of_word(self, word: bytes) -> tuple[int, int, int]:
        parts = (b"w" + word.lower().strip(MARKS), b"e" + word[-ENDING:], b"s" + shape(word))
        return tuple(zlib.crc32(part) & self._mask for part in parts)

    def _learned(self, word: bytes) -> tuple[int, int, int]:
        made = self._of_word(word)
        if len(word) <= LONGEST_CACHED:
            self._known[word] = made
        return made

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and values of a text."""
        known = self._known
        if len(known) > CACHED_WORDS:
            known.clear()
        words = set((text or "").encode().split())
        found = [known.get(w) or self._learned(w) for w in words]
        numbers, values = [], []
        for kind in range(KINDS):
            distinct = np.fromiter({f[kind] for f in found}, np.int32)
            numbers.append(distinct)
            values.append(np.full(len(distinct), max(len(distinct), 1) ** -0.25, np.float32))
        return np.concatenate(numbers), np.concatenate(values)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class OrdinalModel:
    """Shared weights, the ordered thresholds between neighbouring grades and the limit of the tail."""

    weights: np.ndarray
    thresholds: np.ndarray
    min_tail: float = 0.0

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for every score and threshold k."""
        chance = _sigmoid(scores[:, None] - self.thresholds[None, :])
        return np.where(np.isneginf(self.thresholds), 1.0, chance)

    def expected_grade(self, scores: np.ndarray) -> np.ndarray:
        return self.above(scores).sum(1)

    def tail(self, scores: np.ndarray, grade: int) -> np.ndarray:
        """P(grade >= ``grade``)."""
        return self.above(scores)[:, grade - 1] if grade else np.ones(len(scores))


def keep_all() -> OrdinalModel:
    return OrdinalModel(np.zeros(1 << FEATURE_BITS, np.float32), np.full(GRADES - 1, -np.inf))


def _telling(numbers: np.ndarray, of_row: np.ndarray, grades: np.ndarray, size: int) -> np.ndarray:
    """The largest log ratio of a feature's rates on both sides of a threshold."""
    found = np.zeros(size)
    for k in range(GRADES - 1):
        sides = [np.bincount(numbers[s], minlength=size) for s in (of_row <= k, of_row > k)]
        rows = [(grades <= k).sum(), (grades > k).sum()]
        rates = [(side + 1) / (n + 2) for side, n in zip(sides, rows)]
        found = np.maximum(found, np.abs(np.log(rates[0] / rates[1])))
    return found


def fit_ordinal(
    numbers: np.ndarray,
    values: np.ndarray,
    rows: np.ndarray,
    grades: np.ndarray,
    penalty: float = 1e-3,
    steps: int = 200,
    rate: float = 0.08,
    grade_weights: tuple[float, ...] = (1.0,) * GRADES,
    scale_power: float = 1.0,
) -> OrdinalModel:
    """Maximise the penalised likelihood by Adam steps over all rows.

    ``numbers``, ``values`` and ``rows`` list the features of all documents.
    Rows weigh as ``grade_weights`` says.  A feature is scaled by a power of how
    unevenly it falls below and above a threshold, so that the penalty holds back
    what tells little.  Thresholds are a first one plus positive steps, so they
    stay in order.
    """
    if len(np.unique(grades)) < 2:
        return keep_all()
    # Only features that several documents share are fitted; the others keep the weight 0.
    shared = np.flatnonzero(np.bincount(numbers, minlength=1 << FEATURE_BITS) >= MIN_DOCUMENTS)
    at = np.searchsorted(shared, numbers)
    at[at == len(shared)] = 0
    known = shared[at] == numbers if len(shared) else np.zeros(len(numbers), bool)
    numbers, values, rows = at[known], values[known], rows[known]
    n_rows, size = len(grades), len(shared)
    scale = _telling(numbers, grades[rows], grades, size) ** scale_power
    values = values * scale[numbers]
    row_weight = np.array(grade_weights)[grades]
    row_weight /= row_weight.sum()
    parameters = np.zeros(size + GRADES - 1)
    parameters[size] = -0.5
    moment, square = np.zeros_like(parameters), np.zeros_like(parameters)

    def thresholds(raw: np.ndarray) -> np.ndarray:
        return raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])

    for step in range(1, steps + 1):
        weights, raw = parameters[:size], parameters[size:]
        scores = np.bincount(rows, weights[numbers] * values, minlength=n_rows)
        cuts = thresholds(raw)
        # P(grade <= k) with 0 and 1 at the ends; its slope at each cut.
        below = np.column_stack([np.zeros(n_rows), _sigmoid(cuts - scores[:, None]), np.ones(n_rows)])
        slope = below * (1 - below)
        at = np.arange(n_rows)
        chance = np.maximum(below[at, grades + 1] - below[at, grades], 1e-9)
        upper, lower = slope[at, grades + 1] / chance, slope[at, grades] / chance
        by_score = row_weight * (upper - lower)  # of minus the log likelihood
        by_cut = np.zeros(GRADES + 1)
        np.add.at(by_cut, grades + 1, -row_weight * upper)
        np.add.at(by_cut, grades, row_weight * lower)
        by_cut = by_cut[1:-1]
        gradient = np.empty_like(parameters)
        gradient[:size] = np.bincount(numbers, by_score[rows] * values, minlength=size)
        gradient[:size] += penalty * weights
        gradient[size] = by_cut.sum()
        for n in range(1, GRADES - 1):
            gradient[size + n] = by_cut[n:].sum() * np.exp(raw[n])
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        pace = rate * (1 - step / (steps + 1))
        parameters = parameters - pace * (moment / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-8
        )
    weights = np.zeros(1 << FEATURE_BITS, np.float32)
    weights[shared] = parameters[:size] * scale
    return OrdinalModel(weights, thresholds(parameters[size:]))


def _scores(model: OrdinalModel, numbers: np.ndarray, values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, model.weights[numbers] * values, minlength=n)


def fit_with_limit(
    numbers: np.ndarray, values: np.ndarray, rows: np.ndarray, grades: np.ndarray, share: float = KEPT_SHARE
) -> OrdinalModel:
    """The model of all rows, with the highest limit that keeps ``share`` of the selected grade.

    Each row is judged by a model of the other folds.  Where a fold leaves less
    than two grades, or no row has the selected one, the limit is 0.
    """
    fitted = partial(fit_ordinal, penalty=PENALTY, grade_weights=GRADE_WEIGHTS, scale_power=SCALE_POWER)
    fold = np.arange(len(grades)) % FOLDS
    tails = np.empty(len(grades))
    for n in range(FOLDS):
        others = fold != n
        place = np.cumsum(others) - 1
        at = others[rows]
        model = fitted(numbers[at], values[at], place[rows[at]], grades[others])
        tails[~others] = model.tail(_scores(model, numbers, values, rows, len(grades)), SELECTED_GRADE)[~others]
        if np.isneginf(model.thresholds).any():
            return fitted(numbers, values, rows, grades)
    selected = np.sort(tails[grades == SELECTED_GRADE])
    model = fitted(numbers, values, rows, grades)
    if not len(selected):
        return model
    limit = float(selected[int((1 - share) * len(selected))])
    return OrdinalModel(model.weights, model.thresholds, limit)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 low quality, 1 good but toxic, 2 good and clean."""
    grade = F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) == 1, 1).otherwise(2)
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    return known.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade"))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = TextFeatures()
    for batch in batches:
        made = [features.of(text.as_py()) for text in batch.column(2)]
        arrays = [batch.column(0), batch.column(1)]
        arrays.append(pa.array([m[0] for m in made], pa.list_(pa.int32())))
        arrays.append(pa.array([m[1] for m in made], pa.list_(pa.float32())))
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "grade", "numbers", "values"])


def fit(docs: DataFrame, ratings: DataFrame, sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fit to documents with a rating; ``ratings`` has doc_id and grade (0 to ``GRADES`` - 1)."""
    sample = ratings.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample_rows)
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
        .join(F.broadcast(sample), "doc_id")  # of a fixed bound; texts stay where they lie
        .select("doc_id", "grade", "text")
        .mapInArrow(_featured, "doc_id long, grade int, numbers array<int>, values array<float>")
        .orderBy("doc_id", "grade", F.hash("numbers"))
        .toArrow()
    )
    features = [chunk.values.to_numpy() for chunk in rows["numbers"]]
    if not features:
        return keep_all()
    values = np.concatenate([chunk.values.to_numpy() for chunk in rows["values"]])
    at = np.repeat(np.arange(len(features)), [len(f) for f in features])
    grades = rows["grade"].to_numpy().astype(np.int64)
    return fit_with_limit(np.concatenate(features), values, at, grades)


SCORES = "expected_grade double, tail_probability double, kept boolean"


def _scored(model: Broadcast, grade: int, limit: float, keep_text: bool):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by_worker("classifier")  # lets go what other stages have kept
        features, fitted = TextFeatures(), OrdinalModel(*model.value)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for n, text in enumerate(batch.column("text")):
                numbers, values = features.of(text.as_py())
                scores[n] = fitted.weights[numbers] @ values
            tail = fitted.tail(scores, grade)
            made = [pa.array(fitted.expected_grade(scores)), pa.array(tail), pa.array(tail >= limit)]
            names, columns = list(batch.schema.names), list(batch.columns)
            if not keep_text:
                columns.pop(names.index("text"))
                names.remove("text")
            names += ["expected_grade", "tail_probability", "kept"]
            yield pa.RecordBatch.from_arrays([*columns, *made], names)

    return made


def score(
    docs: DataFrame,
    model: OrdinalModel,
    keep: list[str],
    grade: int = SELECTED_GRADE,
    min_tail: float | None = None,
) -> DataFrame:
    """The kept columns, expected grade, P(grade >= ``grade``) and whether that selects the row.

    The limit is the model's unless ``min_tail`` names another.  Kept columns named
    like the scores are replaced.
    """
    shipped = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))
    added = [field.split()[0] for field in SCORES.split(", ")]
    kept = [name for name in keep if name not in (*added, "text")]
    rows = docs.select(*kept, F.col("text").cast("string"))
    fields = [f for f in rows.schema if f.name != "text" or "text" in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    limit = model.min_tail if min_tail is None else min_tail
    return rows.mapInArrow(_scored(shipped, grade, limit, "text" in keep), f"{schema}, {SCORES}")

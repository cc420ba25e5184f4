"""Quality rules learned as a decision list: sequential covering over document statistics.

Rules are conjunctions of thresholds on shares of a document's counts.  They are
learned one after the other from labelled documents: a rule is grown on one
part of the sample by the condition of the highest information gain, pruned on
the other part by dropping its last conditions as long as that does not hurt,
and kept if it is precise enough there; the documents it covers leave the sample.
The list becomes an ordered Spark conditional expression: the first rule that
holds rejects, the end of the list keeps.

Counting runs over all whole texts where they are read, without a shuffle.  The
fit sees at most ``SAMPLE_ROWS`` labelled documents, those with the lowest hash
of the id, as numbers only.  Null texts have no words.  Documents without a
label are judged like the others; without labels of both kinds, or in an empty
table, the list is empty and keeps all that the base rules keep.  A document
labelled twice counts twice.  Null ids are judged, but not learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.doc_stats import with_counts

SAMPLE_ROWS = 20_000
MIN_WORDS = 50

# Every feature is an expression of the counts, for Spark and the fit alike.
FEATURES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        column = values[self.feature]
        return column >= self.threshold if self.at_least else column < self.threshold

    def sql(self) -> str:
        sign = ">=" if self.at_least else "<"
        return f"{FEATURES[self.feature]} {sign} {self.threshold!r}D"

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, values: dict[str, np.ndarray]) -> np.ndarray:
    held = np.ones(len(next(iter(values.values()))), bool)
    for condition in rule:
        held &= condition.holds(values)
    return held


def _gain(bad: np.ndarray, good: np.ndarray, bad_now: int, good_now: int) -> np.ndarray:
    """Bits saved on the covered bad documents, for each candidate."""
    with np.errstate(divide="ignore", invalid="ignore"):
        gained = bad * (np.log2(bad / (bad + good)) - np.log2(bad_now / (bad_now + good_now)))
    return np.where(bad > 0, gained, -np.inf)


def _best_condition(values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, Condition]:
    """The threshold of the highest gain, between neighbouring values of a feature."""
    best = (0.0, None)
    total_bad, total = int(bad.sum()), len(bad)
    for feature, column in values.items():
        order = np.argsort(column, kind="stable")
        sorted_values = column[order]
        places = np.flatnonzero(np.diff(sorted_values) > 0) + 1
        if not len(places):
            continue
        bad_below = np.concatenate([[0], np.cumsum(bad[order])])[places]
        good_below = places - bad_below
        bad_above, good_above = total_bad - bad_below, (total - places) - (total_bad - bad_below)
        for at_least, b, g in ((True, bad_above, good_above), (False, bad_below, good_below)):
            gains = _gain(b, g, total_bad, total - total_bad)
            n = int(np.argmax(gains))
            if gains[n] > best[0] + 1e-9:
                threshold = (sorted_values[places[n]] + sorted_values[places[n] - 1]) / 2
                best = (float(gains[n]), Condition(feature, at_least, float(threshold)))
    return best


def grow(values: dict[str, np.ndarray], bad: np.ndarray, max_conditions: int) -> Rule:
    rule: list[Condition] = []
    left = dict(values)
    while bad.any() and not bad.all() and len(rule) < max_conditions:
        _, condition = _best_condition(left, bad)
        if condition is None:
            break
        rule.append(condition)
        held = condition.holds(left)
        left, bad = {k: v[held] for k, v in left.items()}, bad[held]
    return tuple(rule)


def prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The shortest beginning of the rule with the best (bad - good) / covered."""

    def worth(part: Rule) -> float:
        held = covers(part, values)
        b, n = int(bad[held].sum()), int(held.sum())
        return (2 * b - n) / n if n else -1.0

    parts = [rule[:n] for n in range(1, len(rule) + 1)]
    return max(parts, key=lambda part: (worth(part), -len(part))) if parts else ()


def learn(
    values: dict[str, np.ndarray],
    bad: np.ndarray,
    min_precision: float = 0.95,
    min_covered: int = 5,
    max_rules: int = 12,
    max_conditions: int = 4,
) -> list[Rule]:
    """Sequential covering: two thirds of the rows grow a rule, one third prunes and tests it."""
    rules: list[Rule] = []
    values, bad = dict(values), bad.astype(bool)
    while len(rules) < max_rules and bad.sum() >= min_covered and not bad.all():
        for_test = np.arange(len(bad)) % 3 == 2
        grown = grow({k: v[~for_test] for k, v in values.items()}, bad[~for_test], max_conditions)
        rule = prune(grown, {k: v[for_test] for k, v in values.items()}, bad[for_test])
        held = covers(rule, values) if rule else np.zeros(len(bad), bool)
        tested = held & for_test
        precise = all(
            bad[part].sum() >= min_precision * part.sum() for part in (held, tested)
        )
        if held.sum() < min_covered or not precise:
            break
        rules.append(rule)
        values, bad = {k: v[~held] for k, v in values.items()}, bad[~held]
    return rules


def rejecting_rule(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1 on; null if none does."""
    chosen = F
    for number, rule in enumerate(rules, 1):
        condition = F.expr(" AND ".join(f"({c.sql()})" for c in rule))
        chosen = chosen.when(condition, F.lit(number))
    return chosen.otherwise(F.lit(None).cast("int")) if rules else F.lit(None).cast("int")


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words")


def labelled_sample(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labels, those with the lowest hash of the document's id."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    lot = F.xxhash64("doc_id")
    return known.orderBy(lot, "doc_id", "quality").limit(rows)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn from the labelled documents (``quality`` 0 is bad) that pass the base rules."""
    known = labelled_sample(labels, sample_rows).select(
        F.col("doc_id"), F.col("quality").alias("label of the sample")
    )
    # The sample has a fixed bound, so it may be broadcast; texts are then filtered where they lie.
    labelled = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    sample = with_counts(labelled, ["label of the sample"])
    features = [F.expr(sql).alias(name) for name, sql in FEATURES.items()]
    rows = (
        sample.where(~base_failed())
        .select((F.col("label of the sample") == 0).alias("bad"), *features)
        .orderBy(F.xxhash64(*FEATURES), *FEATURES)
        .toPandas()
    )
    values = {name: rows[name].to_numpy(float) for name in FEATURES}
    return learn(values, rows["bad"].to_numpy(bool))


def judge(counted: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``base_failed``, ``rejected_by`` (number of the rule) and ``kept`` to counted rows."""
    return counted.withColumns(
        {"base_failed": base_failed(), "rejected_by": rejecting_rule(rules)}
    ).withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())

"""The decision list and the ordinal classifier."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridtide.llm import decision_list, quality_classifier
from gridtide.llm.doc_stats import COUNTS, counts, with_counts
from gridtide.llm.quality_classifier import GRADES, OrdinalModel, fit_ordinal, keep_all, shape

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[n : n + 3]) for n in range(len(words) - 2))
    covered = {
        n + k for n in range(len(words) - 2) if windows[tuple(words[n : n + 3])] > 1 for k in range(3)
    }
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é\n\t\x0b|#<A1! 😀"), max_size=80))
def test_counts_equal_brute_force(text):
    assert counts(text)[:5] == brute(text)


def test_counts_of_special_texts():
    for text in (None, "", "a b c a b c", "a a a a", "x\n x\nx\n\n\n", "w " * 20_000, "é" * 10):
        assert counts(text)[:5] == brute(text)
    assert dict(zip(COUNTS, counts("AB c1!! d\nd\n")))["n_capitals"] == 2


def values_of(n, rng):
    return {name: rng.random(n) for name in decision_list.FEATURES}


def test_learned_rules_find_planted_conjunctions():
    rng = np.random.default_rng(0)
    values = values_of(3000, rng)
    bad = (values["symbol_share"] > 0.9) | ((values["capital_share"] > 0.7) & (values["mark_share"] > 0.8))
    rules = decision_list.learn(values, bad)
    held = np.zeros(3000, bool)
    for rule in rules:
        held |= decision_list.covers(rule, values)
    assert (held & bad).sum() > 0.97 * bad.sum() and (held & ~bad).sum() <= 0.01 * bad.sum()


def test_nothing_is_learned_from_noise_or_one_kind():
    rng = np.random.default_rng(1)
    values = values_of(600, rng)
    assert decision_list.learn(values, rng.random(600) < 0.2) == []
    assert decision_list.learn(values, np.ones(600, bool)) == []
    assert decision_list.learn(values, np.zeros(600, bool)) == []


def test_conditional_expression_equals_the_rules(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counted = with_counts(docs, ["doc_id"])
    frame = counted.select("*", *[F.expr(e).alias(n) for n, e in decision_list.FEATURES.items()]).toPandas()
    values = {n: frame[n].to_numpy(float) for n in decision_list.FEATURES}
    middle = {n: float(np.median(v)) for n, v in values.items()}
    condition = decision_list.Condition
    rules = [
        (condition("mean_word_chars", True, middle["mean_word_chars"]), condition("capital_share", False, 0.05)),
        (condition("distinct_share", True, middle["distinct_share"]),),
    ]
    judged = decision_list.judge(counted, rules).toPandas()
    first = [decision_list.covers(rule, values) for rule in rules]
    want = np.where(first[0], 1, np.where(first[1], 2, 0))
    assert judged["rejected_by"].fillna(0).tolist() == want.tolist()
    base = (frame.n_words < 50) | (100 * frame.n_repeat_words > 50 * frame.n_words)
    assert judged["base_failed"].tolist() == base.tolist()
    assert judged["kept"].tolist() == (~base & (want == 0)).tolist()


SMALL = [(1, "a b", "x", None), (None, None, None, "y"), (1, "a b", "x", None), (4, "", "", "")]


def small(spark):
    return spark.createDataFrame(SMALL, "doc_id long, text string, n_words string, kept string")


def test_decision_list_edge_cases(spark):
    docs, empty = small(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rules = decision_list.fit(docs, empty)
    assert rules == []
    got = decision_list.judge(with_counts(docs, ["doc_id", "n_words", "text"]), rules).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.text or "", r.kept) for r in got) == [
        (0, 0, "", False), (1, 2, "a b", False), (1, 2, "a b", False), (4, 0, "", False),
    ]
    assert with_counts(docs.limit(0), ["doc_id"]).count() == 0


def test_held_out_accuracy_of_both(spark):
    """Fitted on the labels of one half of the documents, judged on those of the other."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    train, test = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1").toPandas()
    rules = decision_list.fit(docs, train)
    judged = decision_list.judge(with_counts(docs, ["doc_id"]), rules).toPandas().merge(test, on="doc_id")
    passed = judged[~judged.base_failed]
    assert passed[passed.quality == 1].kept.mean() > 0.99 and passed[passed.quality == 0].kept.mean() < 0.05
    model = quality_classifier.fit(docs, quality_classifier.graded(train))
    scored = quality_classifier.score(docs, model, ["doc_id"]).toPandas().merge(test, on="doc_id")
    clean = (scored.quality == 1) & (scored.toxic == 0)
    # A third of the toxic labels stand on documents without any telling word.
    assert scored[clean].kept.mean() > 0.96 and scored[scored.quality == 0].kept.mean() < 0.2
    assert scored[(scored.quality == 1) & ~clean].kept.mean() < 0.6
    assert (scored.expected_grade.between(0, GRADES - 1)).all()
    means = [scored[g].expected_grade.mean() for g in (scored.quality == 0, (scored.quality == 1) & ~clean, clean)]
    assert means == sorted(means)


MARKERS = {
    "trash", "pathetic", "idiot", "disgusting", "worthless", "clown", "loser", "scum", "stupid", "moron",
}


def test_toxic_documents_with_marker_words_are_rejected(spark):
    """No clean document holds one of these words; fitted on even ids, judged on odd ones."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality_classifier.fit(docs, quality_classifier.graded(labels.where("doc_id % 2 = 0")))
    odd = labels.where("doc_id % 2 = 1").toPandas()
    scored = quality_classifier.score(docs, model, ["doc_id", "text"]).toPandas().merge(odd, on="doc_id")
    marked = scored.text.map(lambda t: not MARKERS.isdisjoint(re.findall(r"\w+", t.lower())))
    clean = (scored.quality == 1) & (scored.toxic == 0)
    toxic = (scored.quality == 1) & (scored.toxic == 1)
    assert not (clean & marked).any() and (toxic & marked).sum() > 100
    assert scored[toxic & marked].kept.mean() < 0.1 and scored[toxic].kept.mean() < 0.4
    assert scored[clean].kept.mean() > 0.96


def test_ordinal_fit_recovers_ordered_grades():
    rng = np.random.default_rng(3)
    rows = 2000
    numbers = rng.integers(0, 30, (rows, 5))
    score = (numbers < 10).sum(1) - (numbers >= 20).sum(1) + rng.normal(0, 0.3, rows)
    grades = np.digitize(score, [-1, 1])
    at = np.repeat(np.arange(rows), 5)
    model = fit_ordinal(numbers.ravel(), np.full(rows * 5, 0.4), at, grades)
    assert model.thresholds[0] < model.thresholds[1]
    scores = np.bincount(at, model.weights[numbers.ravel()] * 0.4)
    assert (np.round(model.expected_grade(scores)) == grades).mean() > 0.8
    above = model.above(scores)
    assert (above[:, 0] >= above[:, 1]).all()
    assert np.allclose(model.tail(scores, 2), above[:, 1]) and (model.tail(scores, 0) == 1).all()


def test_gradient_matches_differences():
    """One Adam step from zero moves every weight against the sign of the slope of the likelihood."""
    numbers, values, at = np.repeat([0, 1, 2], 9), np.ones(27), np.arange(27)
    model = fit_ordinal(numbers, values, at, np.repeat([0, 1, 2], 9), steps=1)
    assert model.weights[0] < 0 < model.weights[2]


def test_classifier_edge_cases(spark):
    docs = small(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        model = quality_classifier.fit(docs, quality_classifier.graded(labels))
        got = quality_classifier.score(docs, model, ["doc_id", "kept", "text"]).collect()
        assert len(got) == 4 and all(r.kept and r.tail_probability == 1.0 for r in got)
    assert quality_classifier.score(docs.limit(0), keep_all(), ["doc_id"]).count() == 0
    grades = quality_classifier.graded(one).collect()
    assert sorted((r.doc_id, r.grade) for r in grades) == [(1, 2), (9, 0)]


@pytest.mark.parametrize(("word", "want"), [(b"Word***", b"Aa*"), (b"ABC!!", b"A!"), ("été9".encode(), b"a0")])
def test_shape(word, want):
    assert shape(word) == want


def test_model_is_plain():
    model = OrdinalModel(np.zeros(2), np.array([0.0, 1.0]))
    assert model.expected_grade(np.array([-50.0, 50.0])).round(6).tolist() == [0.0, 2.0]

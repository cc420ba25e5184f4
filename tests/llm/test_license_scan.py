from __future__ import annotations

import random
import re

from gridtide.llm import license_scan
from gridtide.llm.license_scan import PHRASES, TEMPLATES, Template, rare_postings, scan_licences

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, labels string, words string"
KEEP = ["doc_id"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(text):
    words = WORD.findall(lower(text))
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        found = [n for n in range(len(words)) if words[n : n + len(parts)] == parts]
        starts += found
        labels |= {label} if found else set()
    ends = (min(starts), max(starts)) if starts else (None, None)
    return (len(words), len(starts), *ends, ",".join(sorted(labels)))


def scanned(spark, texts):
    docs = spark.createDataFrame([(n, t, "x", "y") for n, t in enumerate(texts)], SCHEMA)
    return {r.doc_id: r for r in scan_licences(docs, KEEP).collect()}


TEXTS = [
    "Released under the MIT License.", "UNDER THE MIT LICENSE under-the;mit\nlicense",
    "under the mit licenses", "xunder the mit license", "cc by nc cc by nc", "CC BY-NC 4.0", "cc by nc2",
    "Licensed under the Apache License, Version 2.0.", "apache license version 2", "", None, " .,- ",
    "überKelvin İ été", "a\x00b", "the apache license version 2 under the mit license " * 400,
    "mit license", "under the Kmit license", "w " * 30_000 + "cc by nc",
]


def test_base_equals_brute_force(spark):
    rng = random.Random(7)
    vocabulary = "under the mit license apache version 2 cc by nc x , . É".split()
    texts = TEXTS + [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(300)]
    got = scanned(spark, texts)
    for n, text in enumerate(texts):
        r = got[n]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and r.labels == ",".join(sorted(set(r.labels.split(","))))
        assert (r.score == 1.0) if r.n_base else (r.score > 0) == bool(r.labels)


def test_every_template_is_found_amid_other_text(spark):
    filler = "some other words of prose stand here "
    texts = [filler * 5 + t.text.title() + ". " + filler * 3 for t in TEMPLATES]
    got = scanned(spark, texts)
    for n, template in enumerate(TEMPLATES):
        assert template.label in got[n].labels.split(","), template


def test_key_phrases_are_mandatory_and_words_must_be_in_place(spark):
    gnu = "This work is licensed under the GNU General Public License, version {}."
    shuffled = "version public gnu license under 3 general the licensed"
    texts = [gnu.format(3), gnu.format(2), gnu.format(9), shuffled, "gnu general public license version 3",
             "a license a version a public a gnu a general a 3"]
    got = scanned(spark, texts)
    assert [got[n].labels for n in range(6)] == ["gpl-3", "gpl-2", "", "", "", ""]


def test_rarest_words_are_indexed():
    counts = {"the": 900, "license": 50, "under": 800, "mit": 10, "released": 40}
    postings = [p for p in rare_postings(TEMPLATES[:1], counts, 3)]
    assert [(word, at, bit) for word, _, at, _, bit in postings] == [
        ("mit", 3, 1),
        ("released", 0, 2),
        ("license", 4, 4),
    ]


def brute_labels(texts, templates, rare_words, file_words, min_agreeing, min_score):
    """Labels and score of each text, start by start."""
    lists = [WORD.findall(lower(text)) for text in texts]
    held = [set(words) for words in lists]
    vocabulary = {w for t in templates for w in t.words}
    counts = {w: sum(w in own for own in held) for w in vocabulary}

    def rarest(words):
        return sorted(words, key=lambda w: (counts[w], -len(w), w))

    chosen = [set(rarest(set(t.words))[: rare_words + len(t.words) // 20]) for t in templates]
    index = set().union(*chosen)
    out = []
    for words, own in zip(lists, held):
        rare = set(rarest(own & index)[:file_words])
        labels, best = set(), 0.0
        for template, indexed in zip(templates, chosen):
            wanted = template.words
            for start in range(-len(wanted), len(words)):
                agreeing = {
                    w for at, w in enumerate(wanted)
                    if w in indexed & rare and 0 <= start + at < len(words) and words[start + at] == w
                }
                low = max(start - license_scan.MARGIN, 0)
                around = words[low : low + len(wanted) + 2 * license_scan.MARGIN]
                score = len(set(around) & set(wanted)) / len(set(wanted))
                text = f" {' '.join(around)} "
                if len(agreeing) >= min_agreeing and score >= min_score:
                    if all(f" {phrase} " in text for phrase in template.key_phrases):
                        labels.add(template.label)
                        best = max(best, score)
        out.append((labels, best))
    return out


def damaged(rng, words, vocabulary):
    """Words with some replaced, dropped or doubled."""
    out = []
    for word in words:
        chance = rng.random()
        out += [] if chance < 0.02 else [word, word] if chance < 0.03 else [rng.choice(vocabulary)] if chance < 0.07 else [word]
    return out


def test_labels_and_score_equal_brute_force(spark):
    rng = random.Random(12)
    vocabulary = sorted({w for t in TEMPLATES for w in t.words}) + [f"w{n}" for n in range(150)]
    filler = ["the", "of", "software", "license", "w1", "w2", "mit", "and", "or", "version"]
    texts = list(TEXTS[:-1])
    for _ in range(220):
        parts = []
        for _ in range(rng.randint(0, 3)):
            parts += rng.choices(filler + vocabulary[:40], k=rng.randint(0, 40))
            parts += damaged(rng, rng.choice(TEMPLATES).words, vocabulary)
        texts.append(" ".join(parts))
    for rare_words, file_words in ((license_scan.RARE_WORDS, license_scan.FILE_WORDS), (2, 6)):
        docs = spark.createDataFrame([(n, t, "x", "y") for n, t in enumerate(texts)], SCHEMA)
        found = license_scan.template_labels(docs, TEMPLATES, rare_words, file_words).collect()
        digests = {r["text digest"]: (set(r.found), r.best) for r in found}
        words = docs.select("doc_id", license_scan.F.sha2(license_scan.canonical(docs.text), 256).alias("d"))
        got = {r.doc_id: digests.get(r.d, (set(), 0.0)) for r in words.collect()}
        want = brute_labels(texts, TEMPLATES, rare_words, file_words, license_scan.MIN_AGREEING, license_scan.MIN_SCORE)
        assert got == dict(enumerate(want))
        assert sum(bool(labels) for labels, _ in want) > 100


def test_whole_texts_amid_other_words_and_cut_ones(spark):
    whole = max((t for t in TEMPLATES if t.label == "mit"), key=lambda t: len(t.text))
    texts = ["Copyright 2020 someone. " + whole.text, "x " * 3000 + whole.text + " y" * 3000,
             " ".join(whole.words[: len(whole.words) // 2])]
    got = scanned(spark, texts)
    assert [got[n].labels for n in range(3)] == ["mit", "mit", "mit"]
    assert [got[n].score for n in range(2)] == [1.0, 1.0]
    template = Template("own", "Zebra, YAK and the Gnu!", ("yak and",))
    docs = spark.createDataFrame([(1, "a zebra yak and the gnu", "x", "y"), (2, "zebra gnu", "x", "y")], SCHEMA)
    got = {r.doc_id: (r.labels, r.score) for r in scan_licences(docs, KEEP, templates=(template,)).collect()}
    assert got == {1: ("own", 1.0), 2: ("", 0.0)}


def test_the_canonical_text_is_made_once_in_each_pass(spark):
    docs = spark.createDataFrame([(1, "x", "x", "y")], SCHEMA)
    plan = scan_licences(docs, KEEP)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 2


def test_words_stay_where_they_are_while_the_index_is_small(spark, monkeypatch):
    docs = spark.createDataFrame([(1, TEMPLATES[0].text, "x", "y"), (2, "mit license", "x", "y")], SCHEMA)
    whole = [sorted(map(str, license_scan.template_labels(docs).collect()))]

    def shipped():
        plan = license_scan.template_labels(docs)._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "Exchange hashpartitioning(word" in line]

    assert shipped() == []
    monkeypatch.setattr(license_scan, "BROADCAST_POSTINGS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert len(shipped()) == 2
        whole.append(sorted(map(str, license_scan.template_labels(docs).collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert whole[0] == whole[1] and len(whole[0]) == 1


def test_repeated_rows_nulls_and_empty_table(spark):
    rows = [(None, TEXTS[0], "x", "y")] * 3 + [(1, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = scan_licences(docs, KEEP).collect()
    assert sorted((r.doc_id or 0, r.labels, r.score) for r in got) == [(0, "mit", 1.0)] * 3 + [(1, "", 0.0)]
    assert scan_licences(docs.limit(0), KEEP).count() == 0


def test_main_path_has_no_python(spark):
    docs = spark.createDataFrame([(1, "x", "x", "y")], SCHEMA)
    plan = scan_licences(docs, KEEP)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan

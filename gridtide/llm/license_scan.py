"""Licence scan: a positional index of rare template words, confirmed by key phrases.

Words are runs of digits, letters and non-ASCII characters after A-Z are
lower-cased.  Each licence template is indexed under its rarest words, those of
the highest IDF, counted over all documents: the postings are a table of word,
template and position.

A file is looked up by its own rarest index words.  Its words are listed with
their places once, those of the rarest are joined with the postings by the word,
and each pair proposes where the template would start.  Proposals of different
words that agree on template and start are intersected, and a start with enough
of them is verified: all mandatory key phrases must stand around it, and the
share of template words found there is the score.

Beside that, given phrases are found wherever their words stand consecutively.

Everything is built of DataFrame functions.  The canonical text of a document is
made once in each of three passes (word counts, phrases, index).  The work per
word does not grow with the templates: only words of the file's own choice reach
the join.  Proposals are keyed by a digest of the text: copies meet before the
shuffle, so a text a third of all rows share costs one row per task.

A null text counts as empty: no words, no labels, score 0.  Null ids and
repeated rows are scanned like others; an empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm.common import ascii_lower

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE_WORDS = 3  # a template is indexed under so many words, and one more for each twenty it has
MOST_WORDS = 62  # a bit of a long for each
BROADCAST_POSTINGS = 100_000
FILE_WORDS = 24  # a file is looked up by so many of its rarest index words
MIN_AGREEING = 2
MIN_SCORE = 0.8
MARGIN = 6  # words around the expected place in which key phrases may stand


@dataclass(frozen=True)
class Template:
    """Wording of a licence, whole or characteristic, and phrases that must stand in it."""

    label: str
    text: str
    key_phrases: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        """As the scan sees them."""
        lower = "".join(c.lower() if c.isascii() else c for c in self.text)
        return re.sub(NOT_WORD, " ", lower).split()


# Phrases that carry a label wherever they stand.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Sentences by which well-known licences are recognised.
_GNU = (
    "you can redistribute it and or modify it under the terms of the gnu {0} public license as"
    " published by the free software foundation either version {1} of the license or"
)
TEMPLATES = (
    Template("mit", "released under the mit license", ("the mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files",
        ("permission is hereby granted free of charge",),
    ),
    Template(
        "apache-2", "licensed under the apache license version 2 0", ("the apache license version 2",)
    ),
    Template(
        "gpl-3",
        "licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "gpl-2",
        "licensed under the gnu general public license version 2",
        ("gnu general public license version 2",),
    ),
    Template("gpl-3", _GNU.format("general", "3"), ("gnu general public license", "either version 3")),
    Template("gpl-2", _GNU.format("general", "2"), ("gnu general public license", "either version 2")),
    Template(
        "lgpl-3", _GNU.format("lesser general", "3"), ("gnu lesser general public license", "version 3")
    ),
    Template(
        "agpl-3", _GNU.format("affero general", "3"), ("gnu affero general public license", "version 3")
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("the mozilla public license v 2",),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted",
        ("permission to use copy modify",),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
    Template(
        "cc-by", "licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0",),
    ),
    Template(
        "cc-by-sa",
        "licensed under a creative commons attribution sharealike 4 0 international license",
        ("creative commons attribution sharealike",),
    ),
    Template(
        "cc-by-nc",
        "licensed under a creative commons attribution noncommercial 4 0 international license",
        ("creative commons attribution noncommercial 4 0",),
    ),
    Template("cc0", "creative commons zero v1 0 universal", ("creative commons zero",)),
    # Whole texts of short licences.
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons"
        " to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND,"
        " EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS"
        " FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT"
        " HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF"
        " CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE"
        " USE OR OTHER DEALINGS IN THE SOFTWARE.",
        ("permission is hereby granted free of charge", "without warranty of any kind"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this permission"
        " notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL"
        " WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY"
        " AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR"
        " CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,"
        " WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN"
        " CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        ("permission to use copy modify", "the author disclaims all warranties"),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: 1. Redistributions of source code"
        " must retain the above copyright notice, this list of conditions and the following"
        " disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS"
        " AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED"
        " TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
        " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,"
        " INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT"
        " LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR"
        " BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,"
        " STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE"
        " USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
        ("redistribution and use in source and binary forms", "this list of conditions"),
    ),
    Template(
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will"
        " the authors be held liable for any damages arising from the use of this software. Permission"
        " is granted to anyone to use this software for any purpose, including commercial"
        " applications, and to alter it and redistribute it freely, subject to the following"
        " restrictions: 1. The origin of this software must not be misrepresented; you must not claim"
        " that you wrote the original software. If you use this software in a product, an"
        " acknowledgment in the product documentation would be appreciated but is not required."
        " 2. Altered source versions must be plainly marked as such, and must not be misrepresented as"
        " being the original software. 3. This notice may not be removed or altered from any source"
        " distribution.",
        ("must not be misrepresented", "altered source versions must be plainly marked"),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to"
        " copy, modify, publish, use, compile, sell, or distribute this software, either in source"
        " code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any"
        " means. In jurisdictions that recognize copyright laws, the author or authors of this"
        " software dedicate any and all copyright interest in the software to the public domain. We"
        " make this dedication for the benefit of the public at large and to the detriment of our"
        " heirs and successors. We intend this dedication to be an overt act of relinquishment in"
        " perpetuity of all present and future rights to this software under copyright law.",
        ("free and unencumbered software", "dedicate any and all copyright interest"),
    ),
    Template(
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in"
        " writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT"
        " WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the"
        " specific language governing permissions and limitations under the License.",
        ("the apache license version 2", "distributed under the license"),
    ),
)


def canonical(text: Column) -> Column:
    """The words of a text with single spaces between and one at each end."""
    lower = ascii_lower(F.coalesce(text.cast("string"), F.lit("")))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lower, NOT_WORD, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _has(words: Column, phrase: str) -> Column:
    return F.contains(words, F.lit(f" {phrase} "))


def _phrase_places(words: Column, n_words: Column, phrase: str) -> tuple[Column, Column, Column]:
    """How often a phrase stands in canonical words, and its first and last start."""
    held, around = _has(words, phrase), f" {phrase} "
    pieces = F.split(words, f" {phrase}(?= )")
    before = F.substring(words, F.lit(1), F.instr(words, around))
    behind = F.substring_index(words, around, -1)
    count = F.when(held, (F.size(pieces) - 1).cast("long")).otherwise(F.lit(0).cast("long"))
    first = F.when(held, _spaces(before) - 1)
    last = F.when(held, n_words - _spaces(behind) - len(phrase.split()))
    return count, first, last


def _least(columns: list[Column], pick) -> Column:
    return pick(*columns) if len(columns) > 1 else columns[0]


def phrase_scan(docs: DataFrame, phrases: dict[str, str], keep: list[str]) -> DataFrame:
    """The kept columns, word count, places of the phrases and a digest of the words."""
    rows = docs.select(*keep, _bound(canonical(F.col("text"))).alias("words"))
    blank = F.col("words") == "  "
    rows = rows.withColumn("n_words", F.when(blank, 0).otherwise(_spaces(F.col("words")) - 1))
    rows = rows.withColumn("n_words", F.col("n_words").cast("long"))
    places = [_phrase_places(F.col("words"), F.col("n_words"), p) for p in phrases]
    found = [F.when(count > 0, F.lit(label)) for (count, _, _), label in zip(places, phrases.values())]
    return rows.select(
        *keep,
        "n_words",
        sum((count for count, _, _ in places[1:]), places[0][0]).alias("n_base"),
        _least([first for _, first, _ in places], F.least).alias("first_word"),
        _least([last for _, _, last in places], F.greatest).alias("last_word"),
        F.array_compact(F.array(*found)).alias("base found"),
        F.sha2("words", 256).alias("text digest"),
    )


# --- the positional index -------------------------------------------------------


def _bound(column: Column) -> Column:
    """The value as a row of its own: nothing that uses it makes it anew."""
    return F.explode(F.array(column))


def _listed(docs: DataFrame) -> DataFrame:
    """(text digest, list): the words of every text."""
    words = docs.select(_bound(canonical(F.col("text"))).alias("words"))
    return words.select(
        F.sha2("words", 256).alias("text digest"), _bound(F.split(F.trim("words"), " ")).alias("list")
    )


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those with each word; one row per template word comes back."""
    known = F.array(*[F.lit(word) for word in vocabulary])
    # Every document counts once under the empty word as well.
    each = F.concat(F.array_intersect("list", known), F.array(F.lit("")))
    rows = _listed(docs).select(F.explode(each).alias("word")).groupBy("word").count().collect()
    counts = {row.word: row["count"] for row in rows}
    return counts.pop("", 0), counts


def _rarest_first(words: set[str], counts: dict[str, int]) -> list[str]:
    """IDF falls with the document count, so the lowest counts come first; ties go to the longer word."""
    return sorted(words, key=lambda w: (counts.get(w, 0), -len(w), w))


def rare_postings(
    templates: tuple[Template, ...], counts: dict[str, int], rare_words: int
) -> list[tuple[str, int, int, int, int]]:
    """(word, template, position, length, bit): each template under its words of highest IDF."""
    postings = []
    for number, template in enumerate(templates):
        words = template.words
        chosen = _rarest_first(set(words), counts)[: min(rare_words + len(words) // 20, MOST_WORDS)]
        for bit, word in enumerate(chosen):
            places = [n for n, other in enumerate(words) if other == word]
            postings += [(word, number, at, len(words), 1 << bit) for at in places]
    return postings


def template_labels(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    rare_words: int = RARE_WORDS,
    file_words: int = FILE_WORDS,
    min_agreeing: int = MIN_AGREEING,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """(text digest, found labels, best score) of the texts that verify for a template."""
    spark = docs.sparkSession
    _, counts = document_frequencies(docs, sorted({w for t in templates for w in t.words}))
    postings = rare_postings(templates, counts, rare_words)
    index_words = _rarest_first({p[0] for p in postings}, counts)

    # What both arrays hold comes in the order of the first: the rarest first.
    own = F.slice(F.array_intersect(F.array(*[F.lit(w) for w in index_words]), "list"), 1, file_words)
    files = _listed(docs).select("*", _bound(own).alias("rare")).where(F.size("rare") >= min_agreeing)
    hits = files.select("*", F.posexplode("list").alias("place", "word"))
    hits = hits.where(F.array_contains("rare", F.col("word")))
    index = spark.createDataFrame(postings, "word string, template int, at int, length int, bit long")
    table = _template_table(spark, templates)
    if len(postings) <= BROADCAST_POSTINGS:  # beyond that, lists of words go to the postings by the word
        index, table = F.broadcast(index), F.broadcast(table)
    start = F.col("place") - F.col("at")
    around = F.slice("list", F.greatest(start - MARGIN, F.lit(0)) + 1, F.col("length") + 2 * MARGIN)
    around = F.concat(F.lit(" "), F.array_join(around, " "), F.lit(" "))  # smaller than the array
    proposed = hits.join(index, "word").select(
        "text digest", "template", start.alias("start"), "bit", around.alias("around")
    )
    agreed = (
        proposed.groupBy("text digest", "template", "start")
        .agg(F.bit_or("bit").alias("agreeing"), F.any_value("around").alias("around"))
        .where(F.bit_count("agreeing") >= min_agreeing)
    )
    return (
        agreed.join(table, "template")
        .withColumn("score", F.size(F.array_intersect(F.split("around", " "), "wording")) / F.size("wording"))
        .where(F.col("score") >= min_score)
        .where(F.forall("phrases", lambda p: F.contains("around", F.concat(F.lit(" "), p, F.lit(" ")))))
        .groupBy("text digest")
        .agg(F.collect_set("label").alias("found"), F.max("score").alias("best"))
    )


def _template_table(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    rows = [
        (n, t.label, sorted(set(t.words)), list(t.key_phrases)) for n, t in enumerate(templates)
    ]
    schema = "template int, label string, wording array<string>, phrases array<string>"
    return spark.createDataFrame(rows, schema)


def scan_licences(
    docs: DataFrame,
    keep: list[str],
    phrases: dict[str, str] = PHRASES,
    templates: tuple[Template, ...] = TEMPLATES,
) -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels, labels, score.

    Labels are distinct, sorted and joined by commas, empty if there is none.
    A phrase scores 1, a template the share of its words, no label 0.
    """
    scanned = phrase_scan(docs, phrases, keep)
    joined = scanned.join(template_labels(docs, templates), "text digest", "left")
    found = F.coalesce("found", F.array().cast("array<string>"))

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return joined.select(
        *keep,
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        listed(F.col("base found")).alias("base_labels"),
        listed(F.concat("base found", found)).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )

"""License scans by a positional rare-token index.

Method: every template is a statement with a mandatory key phrase. The document frequency of all
licence words is counted over the whole corpus; the word of a key phrase with the highest IDF is its
rare token. A file's rare tokens are looked up in the index: each place of one, less its offset in
the phrase, is where the phrase would start (the postings of all its words must agree on that relative
position). Places where the whole key phrase stands are verified and counted; the statement around it
gives the score, the share of its words that stand in their place.

Whole licence texts (``TEXTS``) have several mandatory phrases, each found the same way by its rare token. The first phrase's
place less its offset is where the text would start; the other phrases must vote for the same start, give or take ``DRIFT``
words (names, numbers of clauses). The score compares every word of the text, from each phrase on at that phrase's start.
The oracle SQL covers the notices; whole texts are tested on files made for it.

Only the document frequencies of the fixed licence words reach the driver (one row per word).
Everything is DataFrame code, one narrow pass over the texts after the counting pass.

Defined cases: null or empty text: no words, labels empty, score 0; overlapping places count each;
repeated rows: one result row each; null doc_id: kept; empty table: no rows; ties in IDF: the first
word of the phrase; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    statement: str
    key: str
    base: bool = False

    @property
    def words(self):
        return self.statement.split()

    @property
    def key_words(self):
        return self.key.split()

    @property
    def key_at(self):
        n = len(self.key_words)
        return next(i for i in range(len(self.words)) if self.words[i:i + n] == self.key_words)


# fixed values: labels, usual statements and their mandatory phrases
TEMPLATES = (
    Template("mit", "released under the mit license", "under the mit license", base=True),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2", base=True),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc", base=True),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl-3", "licensed under the gnu affero general public license version 3", "gnu affero general public license"),
    Template("mpl-2", "licensed under the mozilla public license version 2 0", "mozilla public license version 2"),
    Template("epl-2", "licensed under the eclipse public license version 2 0", "eclipse public license version 2"),
    Template("bsd-3-clause", "licensed under the bsd 3 clause license", "bsd 3 clause"),
    Template("bsd-2-clause", "licensed under the bsd 2 clause license", "bsd 2 clause"),
    Template("isc", "licensed under the isc license", "the isc license"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-4", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc0", "licensed under cc0 1 0 universal", "cc0 1 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "unencumbered software released into the public domain"),
)


@dataclass(frozen=True)
class Text:
    """A whole licence: ``phrases`` must stand in it, in this order; ``absent`` must not."""
    label: str
    text: str
    phrases: tuple[str, ...]
    absent: str = ""

    @property
    def words(self):
        return self.text.split()

    def at(self, phrase: str) -> int:
        key = phrase.split()
        return next(i for i in range(len(self.words)) if self.words[i:i + len(key)] == key)


DRIFT = 40
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions "
    "are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
    "documentation and or other materials provided with the distribution {}this software is provided by the copyright holders and "
    "contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and "
    "fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct "
    "indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or "
    "services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract "
    "strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the "
    "possibility of such damage")
_BSD_PHRASES = ("redistribution and use in source and binary forms", "redistributions of source code must retain the above",
                "redistributions in binary form must reproduce the above")
_ENDORSE = "be used to endorse or promote products derived from this software"
TEXTS = (
    Text("mit",
         "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the "
         "software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
         "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
         "to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial "
         "portions of the software the software is provided as is without warranty of any kind express or implied including but not limited "
         "to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or "
         "copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising "
         "from out of or in connection with the software or the use or other dealings in the software",
         ("permission is hereby granted free of charge to any person obtaining a copy",
          "the rights to use copy modify merge publish distribute sublicense",
          "permission notice shall be included in all copies or substantial portions")),
    Text("bsd-3-clause", _BSD.format(
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission "), (*_BSD_PHRASES, _ENDORSE)),
    Text("bsd-2-clause", _BSD.format(""), _BSD_PHRASES, absent=_ENDORSE),
    Text("isc",
         "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
         "the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims "
         "all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the "
         "author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data "
         "or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or "
         "performance of this software",
         ("permission to use copy modify", "for any purpose with or without fee is hereby granted", "disclaims all warranties with regard to this software")),
)
PHRASES = tuple(dict.fromkeys(p for t in TEXTS for p in (*t.phrases, *([t.absent] if t.absent else ()))))


def tokenised(docs: DataFrame) -> DataFrame:
    words = F.regexp_extract_all(lower_ascii(F.coalesce("text", F.lit(""))), F.lit(WORD), F.lit(0))
    return docs.select("doc_id", words.alias("words"))


def document_frequency(words: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """Files per licence word, over all files (as many rows as the templates have different words)."""
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for t in templates for w in t.words} | {w for p in PHRASES for w in p.split()})])
    # explode_outer: the filter that Spark infers for explode would cut every text into words twice
    rows = (words.select(F.explode_outer(F.array_intersect("words", vocabulary)).alias("w")).where("w IS NOT NULL")
            .groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect())
    return {r.w: r.n for r in rows}


def _rarest(frequency: dict[str, int], phrase: list[str]) -> int:
    return max(range(len(phrase)), key=lambda i: -math.log1p(frequency.get(phrase[i], 0)))


def rare_tokens(frequency: dict[str, int], templates=TEMPLATES) -> list[int]:
    """Offset of each key phrase's highest-IDF word."""
    return [_rarest(frequency, t.key_words) for t in templates]


def _agrees(at: Column, phrase: list[str]) -> list[Column]:
    return [F.coalesce(F.get("words", at + k) == w, F.lit(False)) for k, w in enumerate(phrase)]


def license_scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and ``places``
    (label, start, score of every verified place, by start) of every row of ``docs``."""
    words = tokenised(docs)
    frequency = document_frequency(words, templates)
    rare_at = rare_tokens(frequency, templates)
    phrase_at = {p: _rarest(frequency, p.split()) for p in PHRASES}
    rare = sorted({t.key_words[o] for t, o in zip(templates, rare_at)} | {p.split()[o] for p, o in phrase_at.items()})
    spots = F.filter(F.sequence(F.lit(0), F.size("words") - 1, F.lit(1)), lambda i: F.get("words", i).isin(rare))
    looked = words.withColumn("spots", F.when(F.size("words") > 0, spots).otherwise(F.array().cast("array<int>")))

    def stands(phrase: list[str], o: int) -> Column:
        """Where the whole phrase stands, looked up by its rare token."""
        starts = F.transform(F.filter("spots", lambda i: F.get("words", i) == phrase[o]), lambda i: i - o)
        return F.filter(starts, lambda s: reduce(Column.__and__, _agrees(s, phrase)))

    def texts(t: Text) -> Column:
        """Places of a whole text: every phrase votes for about the same start."""
        offsets = [t.at(p) for p in t.phrases]

        def votes(phrase: str, offset: int, s: Column) -> Column:
            return F.filter(F.transform(stands(phrase.split(), phrase_at[phrase]), lambda i: i - offset), lambda v: F.abs(v - s) <= DRIFT)

        def same(s: Column) -> Column:
            ends = [*offsets[1:], len(t.words)]
            parts = []
            for k, (p, o, end) in enumerate(zip(t.phrases, offsets, ends)):
                at = s if k == 0 else F.get(votes(p, o, s), F.lit(0))
                first = 0 if k == 0 else o
                piece = F.array(*[F.lit(w) for w in t.words[first:end]])
                parts.append(F.transform(F.array(at), lambda v: F.size(F.filter(
                    F.transform(piece, lambda w, i: F.coalesce(F.get("words", v + i + first) == w, F.lit(False))), lambda x: x)))[0])
            return reduce(Column.__add__, parts)

        starts = F.transform(stands(t.phrases[0].split(), phrase_at[t.phrases[0]]), lambda i: i - offsets[0])
        found = F.filter(starts, lambda s: reduce(Column.__and__, [F.size(votes(p, o, s)) > 0 for p, o in zip(t.phrases[1:], offsets[1:])]))
        if t.absent:
            found = F.filter(found, lambda s: ~F.exists(stands(t.absent.split(), phrase_at[t.absent]),
                                                        lambda i: (i >= s) & (i <= s + len(t.words) + DRIFT)))
        return F.transform(found, lambda s: F.struct(
            s.cast("long").alias("start"), F.lit(t.label).alias("label"), F.lit(False).alias("base"), (same(s) / len(t.words)).alias("score")))

    def places(t: Template, o: int) -> Column:
        return F.transform(stands(t.key_words, o), lambda s: F.struct(
            s.cast("long").alias("start"), F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
            (reduce(Column.__add__, [c.cast("int") for c in _agrees(s - t.key_at, t.words)]) / len(t.words)).alias("score")))

    # most files have no rare token at all: the templates are looked at only where there is one
    nothing = F.array().cast("array<struct<start:bigint,label:string,base:boolean,score:double>>")
    all_places = F.when(F.size("spots") > 0, F.array_sort(F.concat(*[places(t, o) for t, o in zip(templates, rare_at)], *[texts(t) for t in TEXTS]))) \
        .otherwise(nothing)
    found = looked.select("doc_id", F.size("words").cast("long").alias("n_words"), all_places.alias("places"))
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform("base", lambda p: p["start"])

    def joined(c):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda p: p["label"]))), ",")

    return (found.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined("base").alias("base_labels"), joined("places").alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"),
        F.transform("places", lambda p: F.struct(p["label"], p["start"], p["score"])).alias("places")))


def oracle_sql(templates=TEMPLATES) -> str:
    """The digest columns in DuckDB SQL, trying every template at every word."""
    rows = ", ".join(f"('{t.label}', {str(t.key_words)}, {str(t.words)}, {t.key_at}, {str(t.base).lower()})" for t in templates)
    return rf"""
        WITH w AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
        t(label, key, stmt, key_at, base) AS (VALUES {rows}),
        hit AS (
            SELECT r, label, base, stmt, key_at, words,
                   unnest(list_filter(range(len(words)), lambda i: words[i + 1 : i + len(key)] = key)) AS start
            FROM w, t WHERE list_contains(words, key[1])),
        place AS (
            SELECT r, label, base, start,
                   len(list_filter(range(len(stmt)), lambda k: start - key_at + k >= 0
                       AND words[start - key_at + k + 1] = stmt[k + 1])) / len(stmt) AS score
            FROM hit),
        per AS (
            SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
                   max(start) FILTER (base) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
            FROM place GROUP BY r)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
               CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
               CAST(coalesce(score, 0) AS DOUBLE) AS score
        FROM w LEFT JOIN per USING (r)"""

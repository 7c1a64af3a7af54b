"""Licence notices through a positional index of rare words, with DataFrame functions alone."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genescreen.llm.common import documents, read, stored

#: Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Template notices as (label, notice, mandatory key phrase).
TEMPLATES = [
    ("mit", "Released under the MIT License", "mit license"),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.', "permission is hereby granted free of charge"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "with or without fee is hereby granted"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", "redistribution and use in source and binary forms"),
    ("apache-2", "Licensed under the Apache License, Version 2.0", "apache license version 2"),
    ("apache-2", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.', "apache license version 2"),
    ("gpl-3", "This work is licensed under the GNU General Public License version 3", "gnu general public license version 3"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gnu general public license as published by"),
    ("lgpl-3", "Licensed under the GNU Lesser General Public License version 3", "gnu lesser general public license"),
    ("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License", "gnu affero general public license"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "mozilla public license"),
    ("unlicense", "This is free and unencumbered software released into the public domain.", "free and unencumbered software"),
    ("cc0", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law", "dedicated the work to the public domain"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", "creative commons attribution 4 0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "creative commons attribution sharealike"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License", "creative commons attribution noncommercial"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa"),
]
#: Least share of a template's inverse document frequencies that must stand in place for its label, and how far off a word may stand.
LEAST_SHARE, TOLERANCE = 0.6, 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def notices() -> list[dict]:
    """Base phrases and templates alike: number, label, words, place and words of the key phrase, and whether it is a base phrase."""
    out = []
    for base, (label, notice, key) in [*((True, (label, p, p)) for p, label in BASE.items()), *((False, t) for t in TEMPLATES)]:
        words, key = [w for w in re.split(_GAP, notice.translate(str.maketrans(_UPPER, _LOWER))) if w], key.split()
        at = next(k for k in range(len(words)) if words[k : k + len(key)] == key)
        out.append({"notice": len(out), "label": label, "words": words, "key_at": at, "key": key, "base": base})
    return out


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), _GAP), "")


def _strings(words) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def document_frequencies(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of documents, and of documents with each word of a notice: at most as many rows as the notices have words."""
    vocabulary = sorted({w for t in notices() for w in t["words"]})
    words = F.array_intersect(_words("text"), F.expr(_strings(vocabulary)))
    rows = docs.select(F.explode(F.array_append(words, F.lit(""))).alias("w")).groupBy("w").count().collect()
    found = {r.w: r["count"] for r in rows}
    return found.pop("", 0), {w: found.get(w, 0) for w in vocabulary}


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base (sorted places with labels), base_labels, labels, score of every document.

    The index has a row (word, notice, offset) for every place of a rare word in a template or base phrase; rare are the words with the
    highest inverse document frequency of each key phrase. A document is looked up for its rare words: each of their places meets the
    index by the word, which gives a notice and where it would start. Postings that agree in that are put together; those that have all
    rare words of the key phrase are candidates, and the whole key phrase is compared with the words around. A base phrase counts
    wherever it stands. A template's label needs at least LEAST_SHARE of the template's inverse document frequencies within TOLERANCE
    words of their places; score is the largest such share, 0 without one.

    A candidate carries the words around it, at most twice the longest notice, not its document; texts are not shuffled. The index
    is as large as the notices, and a word looks up its own postings alone, so cost doesn't grow with notices that a document has no
    rare word of. The pass before counts document frequencies over all documents.

    Null and empty texts have no words. Rows that repeat a doc_id are scanned each for itself, null is a doc_id. An empty table gives an
    empty one. A word is a run of digits, letters and non-ASCII characters, with A-Z lower-cased.
    """
    spark, docs, table = docs.sparkSession, documents(docs), notices()
    total, df = document_frequencies(docs)
    idf = {w: math.log((1 + total) / (1 + n)) for w, n in df.items()}
    rare = sorted({max(t["key"], key=lambda w: (idf[w], w)) for t in table})
    postings = [f"('{w}', {t['notice']}, {k}, {t['key_at'] <= k < t['key_at'] + len(t['key'])}, {sum(x in rare for x in t['key'])})" for t in table for k, w in enumerate(t["words"]) if w in rare]
    index = spark.sql(f"SELECT * FROM VALUES {', '.join(postings)} AS t(word, notice, offset, in_key, need)")
    numbers = lambda ws: "array(" + ", ".join(f"double({idf[w]!r})" for w in ws) + ")"
    rows = [f"({t['notice']}, '{t['label']}', {t['base']}, {_strings(t['words'])}, {numbers(t['words'])}, double({sum(idf[w] for w in t['words'])!r}), {t['key_at']}, {_strings(t['key'])})" for t in table]
    known = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(notice, label, is_base, words, idf, whole, key_at, key)")
    reach = max(len(t["words"]) for t in table) + TOLERANCE

    w = F.col("words")
    places = F.filter(F.transform(w, lambda x, i: F.struct(x.alias("word"), i.alias("at"))), lambda x: x.word.isin(rare))
    around = F.transform(places, lambda x: F.struct(x.word.alias("word"), x["at"].alias("at"), F.greatest(x["at"] - reach, F.lit(0)).alias("first"), F.slice(w, F.greatest(x["at"] - reach, F.lit(0)) + 1, 2 * reach + 1).alias("near")))
    worded = docs.select("doc_id", F.xxhash64("text").alias("h"), _words("text").alias("words"))
    held = stored(worded.select("doc_id", "h", F.size(w).cast("long").alias("n_words"), F.when(F.arrays_overlap(w, F.expr(_strings(rare))), around).alias("hits")))

    hits = held.select("doc_id", "h", F.explode("hits").alias("x")).select("doc_id", "h", "x.*").join(F.broadcast(index), "word")
    hits = hits.withColumn("start", F.col("at") - F.col("offset"))
    met = hits.groupBy("doc_id", "h", "notice", "start").agg(F.size(F.collect_set(F.when(F.col("in_key"), F.col("offset")))).alias("agree"), F.max("need").alias("need"), F.min_by(F.struct("first", "near"), "at").alias("x"))
    met = met.where("agree = need").join(F.broadcast(known), "notice").withColumn("begin", F.col("start") - F.col("x.first"))
    key_begin = F.col("begin") + F.col("key_at")
    whole_key = F.when(key_begin >= 0, F.slice("x.near", F.greatest(key_begin, F.lit(0)) + 1, F.size("key")) == F.col("key")).otherwise(F.lit(False))

    def in_place(i: Column) -> Column:
        first = F.col("begin") + i - TOLERANCE
        near = F.slice("x.near", F.greatest(first, F.lit(0)) + 1, F.greatest(F.lit(0), 2 * TOLERANCE + 1 + F.least(first, F.lit(0))))
        return F.when(F.array_contains(near, F.get("words", i)), F.get("idf", i)).otherwise(F.lit(0.0))

    stood = F.aggregate(F.transform(F.sequence(F.lit(0), F.size("words") - 1), in_place), F.lit(0.0), lambda a, b: a + b)
    share = F.when(F.col("whole") > 0, stood / F.col("whole")).otherwise(F.lit(1.0))
    met = met.where(whole_key).select("doc_id", "h", "label", "is_base", "start", F.when(~F.col("is_base"), share).alias("share"))
    base = F.when(F.col("is_base"), F.struct(F.col("start").alias("at"), "label"))
    found = met.groupBy(F.col("doc_id").alias("d"), F.col("h").alias("g")).agg(F.array_sort(F.collect_set(base)).alias("base"), F.collect_set(F.when(F.col("share") >= LEAST_SHARE, F.col("label"))).alias("own"), F.max("share").alias("share"))
    out = held.drop("hits").join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left")
    base = F.coalesce("base", F.array().cast("array<struct<at:int,label:string>>"))
    base_labels = F.array_sort(F.array_distinct(F.col("base.label")))
    out = out.select("doc_id", "n_words", base.alias("base"), F.coalesce("own", F.array().cast("array<string>")).alias("own"), F.round(F.least(F.lit(1.0), F.coalesce("share", F.lit(0.0))), 6).alias("score"))
    return out.select("doc_id", "n_words", "base", base_labels.alias("base_labels"), F.array_sort(F.array_union(base_labels, "own")).alias("labels"), "score")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    at = F.col("base.at")
    return scan(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def _oracle() -> str:
    """The same by plain comparison of every place of every document with every phrase and template."""
    base = ", ".join(f"('{p}', '{label}')" for p, label in BASE.items())
    templates = ", ".join(f"({t['notice']}, '{t['label']}', '{' '.join(t['words'])}', '{' '.join(t['key'])}', {t['key_at']})" for t in notices() if not t["base"])
    return rf"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS at FROM doc_words),
base(phrase, label) AS (VALUES {base}),
templates(t, label, notice, key, k) AS (VALUES {templates}),
sought AS (SELECT phrase FROM base UNION SELECT key FROM templates),
first_words AS (SELECT phrase, split_part(phrase, ' ', 1) AS word, len(string_split(phrase, ' ')) AS n FROM sought),
standing AS (
  SELECT p.doc_id, p.at, f.phrase FROM places p JOIN first_words f USING (word) JOIN doc_words d ON d.doc_id = p.doc_id
  WHERE array_to_string(d.w[p.at + 1 : p.at + f.n], ' ') = f.phrase),
based AS (
  SELECT s.doc_id, count(*) AS n_base, min(s.at) AS first_word, max(s.at) AS last_word, list(DISTINCT b.label) AS labels
  FROM standing s JOIN base b USING (phrase) GROUP BY s.doc_id),
template_words AS (SELECT t, label, key, k, unnest(string_split(notice, ' ')) AS word, unnest(range(len(string_split(notice, ' ')))) AS i FROM templates),
vocabulary AS (SELECT DISTINCT word FROM template_words),
frequencies AS (SELECT v.word, count(DISTINCT p.doc_id) AS df FROM vocabulary v LEFT JOIN places p USING (word) GROUP BY v.word),
idf AS (SELECT word, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) AS idf FROM frequencies),
whole AS (SELECT t, sum(idf) AS idf FROM template_words JOIN idf USING (word) GROUP BY t),
in_place AS (
  SELECT DISTINCT s.doc_id, s.at, t.t, t.i, t.word
  FROM standing s JOIN template_words t ON t.key = s.phrase
  JOIN places p ON p.doc_id = s.doc_id AND p.word = t.word AND p.at BETWEEN s.at + t.i - t.k - {TOLERANCE} AND s.at + t.i - t.k + {TOLERANCE}),
shares AS (
  SELECT n.doc_id, n.at, n.t, sum(i.idf) / any_value(h.idf) AS share
  FROM in_place n JOIN idf i USING (word) JOIN whole h ON h.t = n.t GROUP BY n.doc_id, n.at, n.t),
owned AS (
  SELECT s.doc_id, max(s.share) AS score, list(DISTINCT t.label) FILTER (WHERE s.share >= {LEAST_SHARE}) AS labels
  FROM shares s JOIN templates t USING (t) GROUP BY s.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(o.labels, [])))), ','), '') AS labels,
  round(least(1.0, coalesce(o.score, 0.0)), 6) AS score
FROM doc_words d LEFT JOIN based b USING (doc_id) LEFT JOIN owned o USING (doc_id)
"""


OP9_SQL = _oracle()

"""License scans by diagonal voting (DataFrame functions only).

Every word position of every text joins, by the hashes of its rolling word pair and triple, the positions of those grams
in the license templates (triples; pairs for templates of two words).  A hit, whose words are compared too, votes for
the diagonal "text position - template position".  Votes are summed by diagonal, and neighbouring diagonals are merged
into windows whose width is one for every SLACK words of the template (at most MOST_SLACK), so that some words may be added
or missing, but no chain of diagonals drifts away.  Windows with enough votes are verified as spans: hits are read in the
order of the text, one counts if it lies further on in the template than all before it, and the template's words under
the hits that count must be at least MIN_COVER of all.  So a span is at most the template's length and the slack.

Words: A-Z is lower-cased, then a word is a run of characters other than ASCII signs.  Base phrases are one gram each, so
they stand whole.  Templates are a table (label, phrase), small ones are broadcast after their grams were counted.

Defined results: null text counts as empty; a text without words has 0 words and no labels; each place of a base phrase
counts, overlapping ones too; repeated rows give a row each; score is the best coverage of any label, 0 without one;
templates of fewer than two words find nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved

#: Fixed phrases and labels of the base.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: The method's own labels: sentences by which licenses announce themselves.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "this work is licensed under a creative commons attribution license": "creative-commons",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it": "gpl-notice",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: Whole texts of licenses and notices, word by word.
TEXTS = {
    "mit-text": """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
documentation files the software to deal in the software without restriction including without limitation the rights to use copy
modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is
furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in
all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied
including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event
shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or
otherwise arising from out of or in connection with the software or the use or other dealings in the software""",
    "bsd-2-clause-text": """redistribution and use in source and binary forms with or without modification are permitted provided that
the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions
and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and
the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by
the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied
warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or
contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to
procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory
of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of
this software even if advised of the possibility of such damage""",
    "isc-text": """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the
author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no
event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from
loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection
with the use or performance of this software""",
    "zlib-text": """this software is provided as is without any express or implied warranty in no event will the authors be held liable
for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including
commercial applications and to alter it and redistribute it freely subject to the following restrictions""",
    "apache-2.0-notice": """licensed under the apache license version 2 0 the license you may not use this file except in compliance
with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law
or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of
any kind either express or implied see the license for the specific language governing permissions and limitations under the
license""",
    "gpl-3.0-notice": """this program is free software you can redistribute it and or modify it under the terms of the gnu general
public license as published by the free software foundation either version 3 of the license or at your option any later version
this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of
merchantability or fitness for a particular purpose see the gnu general public license for more details""",
}
#: Share of a template's words that a span must hold.
MIN_COVER = 0.75
#: Words of a template for each step in width of a window of diagonals; the most steps.
SLACK, MOST_SLACK = 8, 12
#: Words of a gram.
GRAM = 3
#: Grams of all templates that are broadcast at most, some 100 bytes each.
BROADCAST_GRAMS = 200_000
#: A-Z are word characters here, as they are lower-cased first.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def own_templates(spark: SparkSession) -> DataFrame:
    """label, phrase, base of the templates above."""
    rows = [(label, phrase, True) for phrase, label in BASE.items()] + [(label, phrase, False) for phrase, label in NOTICES.items()] + [(label, phrase, False) for label, phrase in TEXTS.items()]
    return spark.createDataFrame(rows, "label string, phrase string, base boolean")


def _grams(words: Column) -> Column:
    """From each position on the words a, b, c; null beyond the end."""
    after = lambda n: F.slice(words, F.lit(n + 1), F.greatest(F.size(words) - n, F.lit(0)))
    return F.arrays_zip(words.alias("a"), after(1).alias("b"), after(2).alias("c"))


def _hash(*words: Column) -> Column:
    return F.xxhash64(*[F.lower(w) for w in words])


def template_grams(templates: DataFrame) -> DataFrame:
    """tmpl, label, base, size (words), slack, k, at, ta, tb, tc, h: a row for each gram of each template."""
    words = F.split(F.trim(F.regexp_replace(F.translate("phrase", UPPER, LOWER), r"\s+", " ")), " ")
    rows = templates.select("label", "base", words.alias("w")).where(F.size("w") > 1)
    rows = rows.withColumn("tmpl", F.xxhash64("label", "base", F.array_join("w", " "))).withColumn("size", F.size("w")).withColumn("k", F.least("size", F.lit(GRAM)))
    rows = rows.withColumn("slack", F.least(F.floor(F.col("size") / SLACK), F.lit(MOST_SLACK)).cast("int"))
    rows = rows.select("tmpl", "label", "base", "size", "slack", "k", F.posexplode(_grams(F.col("w"))).alias("at", "g")).where("at <= size - k")
    rows = rows.select("tmpl", "label", "base", "size", "slack", "k", "at", F.col("g.a").alias("ta"), F.col("g.b").alias("tb"), F.when(F.col("k") == GRAM, F.col("g.c")).alias("tc"))
    return rows.withColumn("h", F.when(F.col("k") == 2, _hash(F.col("ta"), F.col("tb"))).otherwise(_hash(F.col("ta"), F.col("tb"), F.col("tc"))))


def _hits(docs: DataFrame, grams: DataFrame, key: str, text: str) -> DataFrame:
    """row, id, n_words, pos, tmpl, at: hits, and for each text at least one row, without template where it is no hit."""
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0))
    rows = docs.select(F.col(key).alias("id"), words.alias("w")).select(F.monotonically_increasing_id().alias("row"), "id", F.size("w").cast("long").alias("n_words"), "w")
    places = rows.select("row", "id", "n_words", F.posexplode_outer(_grams(F.col("w"))).alias("pos", "g")).select("row", "id", "n_words", F.col("pos").cast("long").alias("pos"), "g.*")
    both = F.array(_hash(F.col("a"), F.col("b")), _hash(F.col("a"), F.col("b"), F.col("c")))
    places = places.select("*", F.posexplode(both).alias("which", "hash"))
    same = lambda x, y: F.translate(F.col(x), UPPER, LOWER) == F.col(y)
    third = (F.col("k") == 2) & (F.col("which") == 0) | (F.col("which") == 1) & F.col("c").isNotNull() & same("c", "tc")
    small = F.broadcast(grams) if grams.count() <= BROADCAST_GRAMS else grams
    met = places.join(small.drop("label", "base", "size", "slack"), (F.col("hash") == F.col("h")) & F.col("b").isNotNull() & same("a", "ta") & same("b", "tb") & third, "left")
    return met.where(F.col("tmpl").isNotNull() | (F.coalesce("pos", F.lit(0)) == 0) & (F.col("which") == 0)).select("row", "id", "n_words", "pos", "tmpl", "at")


def spans(hits: DataFrame, templates: DataFrame) -> DataFrame:
    """row, label, base, pos (base places only), cover: base places, and verified spans of the other templates."""
    found = hits.where("tmpl IS NOT NULL").join(F.broadcast(templates) if templates.count() <= BROADCAST_GRAMS else templates, "tmpl").withColumn("diag", F.col("pos") - F.col("at"))
    whole = found.where("base AND k = size").select("row", "label", "base", "pos", F.lit(1.0).alias("cover"))
    found = found.where("NOT (base AND k = size)")
    votes = found.groupBy("row", "tmpl", "diag").agg(F.count(F.lit(1)).alias("n"), F.first("slack").alias("slack"), F.first("size").alias("size"))
    # each window begins at a diagonal with votes
    windows = votes.withColumn("start", F.explode(F.sequence(F.col("diag") - F.col("slack"), F.col("diag")))).groupBy("row", "tmpl", "start").agg(F.sum("n").alias("inside"), F.max(F.col("start") == F.col("diag")).alias("own"), F.first("slack").alias("slack"), F.first("size").alias("size"))
    windows = windows.where(F.col("own") & (F.col("inside") * GRAM >= F.col("size") * MIN_COVER))
    windows = windows.select("row", "tmpl", "start", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("slack"))).alias("diag"))
    read = Window.partitionBy("row", "tmpl", "start").orderBy("pos", "at")
    further = found.join(windows, ["row", "tmpl", "diag"]).withColumn("before", F.max("at").over(read.rowsBetween(Window.unboundedPreceding, -1))).where("before IS NULL OR at > before")
    # rising hits: each adds the words that the one before it does not cover
    more = F.least("k", F.coalesce(F.col("at") - F.lag("at").over(Window.partitionBy("row", "tmpl", "start").orderBy("at")), F.col("k")))
    cover = further.withColumn("more", more).groupBy("row", "tmpl", "start", "label", "base", "size").agg((F.sum("more") / F.col("size")).alias("cover"))
    cover = cover.where(F.col("cover") >= F.when(F.col("base"), F.lit(1.0)).otherwise(F.lit(MIN_COVER)))
    return whole.unionByName(cover.select("row", "label", "base", F.when(F.col("base"), F.col("start")).alias("pos"), "cover"))


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: DataFrame | None = None) -> DataFrame:
    """key, n_words, n_base, first_word, last_word, base_labels, labels, score for every row.

    `templates` (label, phrase) are looked for besides the base phrases; without it, the module's own."""
    own = own_templates(docs.sparkSession)
    if templates is not None:
        own = own.where("base").unionByName(templates.select("label", "phrase", F.lit(False).alias("base")))
    grams = saved(template_grams(own), "templates")
    hits = saved(_hits(docs, grams, key, text), "hits")
    found = spans(hits, grams.select("tmpl", "label", "base", "size", "slack", "k").distinct())
    joined = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("label")))), ",")
    place = F.when(F.col("base"), F.col("pos"))
    side = found.groupBy("row").agg(
        F.count(place).alias("n_base"), F.min(place).alias("first_word"), F.max(place).alias("last_word"),
        joined(F.col("base")).alias("base_labels"), joined(F.lit(True)).alias("labels"), F.max("cover").alias("score"))
    rows = hits.select("row", "id", "n_words").distinct().join(side, "row", "left")
    return rows.select(
        F.col("id").alias(key), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))

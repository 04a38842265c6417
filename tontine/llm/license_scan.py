"""License scan by diagonal voting.

Every rolling k-gram of a document's words is hashed and joined to the places of the
same hash in a small table of license templates.  A hit at word p of the document and
word q of the template votes for the diagonal p - q: a copy of the template puts all its
votes on one diagonal, or, where words were put in or left out, on neighbouring ones.
Diagonals of one (document, template) that lie within the template's slack are merged,
and the merged span is verified on the words themselves: a hit counts only if the words
of its grams are the same, and the span's share is that of the template's words that
such grams cover.

Templates are of two sorts.  Phrases (2-grams, no slack) hold only if every word is
there; notices (5-grams, slack of 3 words) hold from ``SHARE`` of their words on.  The
template table has a few hundred rows, whatever the corpus (``template_grams`` checks
it), so it is broadcast and no gram of a document ever reaches the shuffle: only hits
do, and one row a document, dealt once by document.  SQL functions only.

Results for odd input: null text counts as empty and has no words, so no labels and
score 0; rows that share an id are scanned each; a null id is an id; places of one
phrase are counted each, also where they touch; an empty table gives an empty result;
whole texts of any length are read; other columns are not looked at, whatever their
names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tontine.llm.batches import text_of

#: Share of a notice's words that must be found on its diagonals.
SHARE = 0.8
PHRASE_GRAM, NOTICE_GRAM = 2, 5
NOTICE_SLACK = 3
#: Most template grams that are broadcast.
MOST_GRAMS = 100_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    base: bool = False                                     # counted in n_base, first_word and last_word
    notice: bool = False                                   # verified from SHARE on, else in full

    @property
    def gram(self) -> int:
        return NOTICE_GRAM if self.notice else PHRASE_GRAM

    @property
    def slack(self) -> int:
        return NOTICE_SLACK if self.notice else 0

    @property
    def least(self) -> float:
        return SHARE if self.notice else 1.0


# Phrases that name a license, and paragraphs of the public license texts.
BASE_PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
PHRASES = [
    ("cc-by", "cc by 4 0"), ("cc-by", "cc by 3 0"), ("cc-by", "cc by 2 0"),
    ("cc-by-nc", "cc by nc"), ("cc-by-sa", "cc by sa"), ("cc-by-nd", "cc by nd"), ("cc0", "cc0 1 0"),
    ("cc-by", "creative commons attribution 4 0"), ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("gpl-2", "general public license version 2"), ("gpl-3", "general public license version 3"),
    ("lgpl", "lesser general public license"), ("agpl", "affero general public license"),
    ("apache-2", "apache license version 2 0"), ("bsd", "bsd license"), ("bsd-2", "bsd 2 clause"), ("bsd-3", "bsd 3 clause"),
    ("isc", "isc license"), ("mpl", "mozilla public license"), ("epl", "eclipse public license"),
]
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the software"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is "
                 "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def templates() -> list[Template]:
    return [*[Template(label, tuple(t.split()), base=True) for label, t in BASE_PHRASES],
            *[Template(label, tuple(t.split())) for label, t in PHRASES],
            *[Template(label, tuple(t.split()), notice=True) for label, t in NOTICES]]


def _let(value: Column, f) -> Column:
    """``f(value)``, evaluated once: a filter pushed below would repeat an expression named in a lambda each time."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _grams(words: Column, k: int) -> Column:
    """(place, hash, words) of every rolling k-gram of an array of words."""
    def at(w: Column, i: Column) -> Column:
        gram = F.concat_ws(" ", *[F.get(w, i + j) for j in range(k)])
        return _let(gram, lambda g: F.struct(i.alias("p"), F.xxhash64(g).alias("h"), g.alias("gram")))

    def grams(w: Column) -> Column:
        places = F.when(F.size(w) >= k, F.sequence(F.lit(0), F.size(w) - k)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: at(w, i))
    return _let(words, grams)


def template_grams(spark: SparkSession, given: list[Template]) -> DataFrame:
    """One row a rolling gram of a template: (t, q, h); the table is small by this check, so it may be broadcast."""
    size = sum(max(len(t.words) - t.gram + 1, 0) for t in given)
    if size > MOST_GRAMS or any(len(t.words) < t.gram for t in given):
        raise ValueError(f"templates of at least a gram's words and {MOST_GRAMS} grams in all, not {size}")
    literal = [F.struct(F.lit(n).alias("t"), F.array(*[F.lit(w) for w in t.words]).alias("w"), F.lit(t.notice).alias("notice"))
               for n, t in enumerate(given)]
    rows = spark.range(1).select(F.inline(F.array(*literal)))
    grams = F.when(F.col("notice"), _grams(F.col("w"), NOTICE_GRAM)).otherwise(_grams(F.col("w"), PHRASE_GRAM))
    return rows.select("t", F.explode(grams).alias("g")).select(
        "t", F.col("g.p").alias("q"), F.col("g.h").alias("h"), F.col("g.gram").alias("template_gram"))


def hits(docs: DataFrame, given: list[Template], id_col: str, text_col: str) -> DataFrame:
    """(row, id, n_words) once a document, with t = -1, and (row, t, p, q) of its verified hits."""
    words = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    read = (docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
            .select("id", F.monotonically_increasing_id().alias("row"), words.alias("words")))
    own = F.struct(F.lit(-1).alias("p"), F.xxhash64(F.lit("")).alias("h"), F.lit("").alias("gram"))       # no gram is empty
    grams = read.select("id", "row", F.size("words").cast("long").alias("n_words"),
                        F.concat(F.array(own), _grams(F.col("words"), PHRASE_GRAM), _grams(F.col("words"), NOTICE_GRAM)).alias("grams"))
    spark = docs.sparkSession
    table = template_grams(spark, given).unionByName(
        spark.range(1).select(F.lit(-1).alias("t"), F.lit(0).alias("q"), F.xxhash64(F.lit("")).alias("h"), F.lit("").alias("template_gram")))
    # outer: else Spark infers a filter on the array's size and makes all hashes a second time for it
    joined = (grams.select("id", "row", "n_words", F.explode_outer("grams").alias("g"))
              .select("id", "row", "n_words", F.col("g.p").alias("p"), F.col("g.h").alias("h"), F.col("g.gram").alias("gram"))
              .join(F.broadcast(table), "h"))
    document = F.col("t") == -1
    return joined.select("row", "t", "p", "q", (F.col("gram") == F.col("template_gram")).alias("same"),
                         F.when(document, F.col("id")).alias("id"), F.when(document, F.col("n_words")).alias("n_words"))


def scan_licenses(docs: DataFrame, given: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's ``id``, ``n_words``, ``spans`` (label, base, start and end in words, share; those that
    hold, by start) and ``score``, the greatest share of any candidate, held or not."""
    given = templates() if given is None else given
    of = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("t"))
    found = hits(docs, given, id_col, text_col).repartition("row")         # the only shuffle
    voted = (found.groupBy("row", "t", (F.col("p") - F.col("q")).alias("diagonal"))
             .agg(F.min("p").alias("lo"), F.max("p").alias("hi"), F.collect_set(F.when(F.col("same"), F.col("q"))).alias("places"),
                  F.max("id").alias("id"), F.max("n_words").alias("n_words")))
    along = Window.partitionBy("row", "t").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > of([t.slack for t in given]), F.lit(True))
    merged = (voted.withColumn("apart", apart.cast("int")).withColumn("span", F.sum("apart").over(along.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("row", "t", "span").agg(F.min("lo").alias("start"), F.max("hi").alias("hi"), F.flatten(F.collect_list("places")).alias("places"),
                                               F.max("id").alias("id"), F.max("n_words").alias("n_words")))
    k = of([t.gram for t in given])
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda q: F.sequence(q, q + F.col("k") - 1)))))
    checked = (merged.withColumn("k", k).withColumn("share", covered.cast("double") / of([len(t.words) for t in given]))
               .withColumn("held", F.col("share") >= of([t.least for t in given])))
    span = F.struct(F.col("start").cast("long").alias("start"), (F.col("hi") + F.col("k")).cast("long").alias("end"),
                    of([t.label for t in given]).alias("label"), of([t.base for t in given]).alias("base"), "share")
    template = F.col("t") >= 0
    return checked.groupBy("row").agg(
        F.max("id").alias("id"), F.max("n_words").alias("n_words"), F.array_sort(F.collect_list(F.when(template & F.col("held"), span))).alias("spans"),
        F.coalesce(F.max(F.when(template, F.col("share"))), F.lit(0.0)).alias("score")).drop("row")

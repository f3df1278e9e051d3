"""License scans by diagonal voting: rolling word k-gram hashes joined to template positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Base phrases and their labels.
PHRASES = {
    "cc-by": "cc by",
    "gpl": "general public license",
    "reserved": "all rights reserved",
}
#: Opening or key passages of public licenses, and the labels the method adds.
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "apache-2.0": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike international license",
    "cc-notice": "this work is licensed under a creative commons attribution international license",
}
#: Short references to public licenses, and the labels the method adds. The first words of some are those of others and only
#: the last ones tell them apart, so all of them must stand whole.
REFERENCES = [
    ("mit", "mit license"),
    ("apache-2.0", "apache license version 2 0"),
    ("apache-2.0", "apache license 2 0"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-2", "gnu gpl v2"),
    ("gpl-3", "gnu general public license version 3"),
    ("gpl-3", "gnu gpl v3"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "bsd license"),
    ("bsd", "bsd 2 clause license"),
    ("bsd", "bsd 3 clause license"),
    ("isc", "isc license"),
    ("mpl-2.0", "mozilla public license version 2 0"),
    ("cc-by-4.0", "cc by 4 0"),
    ("cc-by-4.0", "creative commons attribution 4 0 international"),
    ("cc-by-sa-4.0", "cc by sa 4 0"),
    ("cc-by-sa-4.0", "creative commons attribution sharealike 4 0 international"),
    ("cc-by-nc-4.0", "cc by nc 4 0"),
    ("cc-by-nc-4.0", "creative commons attribution noncommercial 4 0 international"),
]
#: Templates of up to so many words must stand whole; parts of longer ones count.
WHOLE_WORDS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words with their capitals; A-Z are letters, as they are after lower-casing."""
    return F.array_remove(F.split(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), "")


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda x: F.xxhash64(F.lower(x)))


def _gram_hash(hashes: Column, i, n: int) -> Column:
    """Hash of the n words from place i on, combined from the hashes that each word has once."""
    return F.xxhash64(F.lit(n), *[F.get(hashes, i + j) for j in range(n)])


def template_grams(spark: SparkSession, templates: list[tuple[str, str]], k: int) -> DataFrame:
    """(template, label, size, grams, at, gram, h) of every template position; a template of fewer than k words is one gram.

    Its size is fixed by the templates, so it may be broadcast.
    """
    rows = []
    for t, (label, text) in enumerate(templates):
        w = text.split()
        n = min(k, len(w))
        rows += [(t, label, len(w), len(w) - n + 1, i, w[i : i + n]) for i in range(len(w) - n + 1)]
    df = spark.createDataFrame(rows, "template int, label string, size int, grams int, at int, gram array<string>")
    sizes = sorted({len(r[-1]) for r in rows})
    h = F.coalesce(*[F.when(F.size("gram") == n, _gram_hash(_word_hashes(F.col("gram")), F.lit(0), n)) for n in sizes])
    return df.withColumn("h", h)


def known() -> list[tuple[str, str]]:
    return [*PHRASES.items(), *NOTICES.items(), *REFERENCES]


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, k: int = 4, slack: int = 3, min_share: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, spans, an array of (label, first, last, share) verified spans, by place.

    ``templates`` are (label, text in lower-case words). The hash of every k-gram position of every text is rolled up from its
    words' hashes; positions whose hash no template has are dropped in place, the others are joined by hash to the broadcast template
    positions and verified word by word, so an exploded row carries k words and a text takes time in proportion to its
    length. Hits vote for a diagonal (place in text less place in template); neighbouring diagonals at most ``slack`` apart
    merge, so the hits of a span keep the template's order but for ``slack`` words. A merged span of a template of more than
    WHOLE_WORDS words counts if verified hits cover ``min_share`` of its grams, and where such spans overlap only those with the
    greatest share do: look-alike templates share runs of words. Shorter templates must stand whole, with all of their grams in a
    place no longer than they are but for ``slack`` words, as one word may tell two licenses apart; those of fewer than k words are
    single grams, each place a span. Null and empty texts: no words, no spans. Repeated rows and null ids are rows of their own; other columns are not
    read. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    grams = template_grams(spark, known() if templates is None else templates, k)
    by_size: dict[int, list[int]] = {}
    for r in grams.select(F.size("gram").alias("n"), "h").distinct().collect():  # a row a template place
        by_size.setdefault(r["n"], []).append(r["h"])
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), words_of(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("w"))
    rows = rows.select("rid", "doc_id", "w", _word_hashes(F.col("w")).alias("wh"))

    def candidates(n: int) -> Column:
        places = F.when(F.size("w") >= n, F.sequence(F.lit(0), F.size("w") - n)).otherwise(F.array().cast("array<int>"))
        found = F.filter(places, lambda i: _gram_hash(F.col("wh"), i, n).isin(by_size[n]))
        return F.transform(found, lambda i: F.struct(i.alias("pos"), _gram_hash(F.col("wh"), i, n).alias("h"), F.transform(F.slice("w", i + 1, n), lambda x: F.translate(x, UPPER, LOWER)).alias("gram")))

    # a document's own row finds the row that no template has, so every document stays
    own = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(0).cast("long").alias("h"), F.array().cast("array<string>").alias("gram")))
    marks = spark.createDataFrame([(None, None, 0, 0, 0, [], 0)], grams.schema)
    found = rows.select("rid", "doc_id", F.size("w").cast("long").alias("n_words"), F.concat(own, *[candidates(n) for n in sorted(by_size)]).alias("g"))
    # outer: the planner would else ask first whether there is an element, by a filter that makes the word hashes anew at every place
    hits = found.select("rid", "doc_id", "n_words", F.explode_outer("g").alias("g")).select("rid", "doc_id", "n_words", "g.pos", "g.h", "g.gram").join(F.broadcast(grams.unionByName(marks)), ["h", "gram"])
    # votes of a diagonal: the distinct template places it covers (a bounded number) and where it runs
    votes = hits.groupBy("rid", "doc_id", "n_words", "template", "label", "size", "grams", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("covered"), F.min("pos").alias("first"), F.max("pos").alias("last")
    )
    by = Window.partitionBy("rid", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(by) > slack) | F.lag("diagonal").over(by).isNull() | (F.col("size") < k)
    spans = (
        votes.withColumn("band", F.sum(apart.cast("int")).over(by))
        .groupBy("rid", "doc_id", "n_words", "template", "label", "size", "grams", "band")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))
        .withColumn("share", F.try_divide("n", "grams"))
    )
    size, end = F.col("size"), F.col("last") + F.least("size", F.lit(k))
    whole = (F.col("share") >= 1) & (end - F.col("first") <= size + slack)
    spans = spans.withColumn("real", F.col("template").isNotNull() & F.when(size <= WHOLE_WORDS, whole).otherwise(F.col("share") >= min_share))
    # long spans that overlap stand in one place: its number grows where a span begins behind all before it
    spans = spans.withColumn("long", F.col("real") & (size > WHOLE_WORDS)).withColumn("end", end)
    before = F.max("end").over(Window.partitionBy("rid", "long").orderBy("first", "end", "template").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("_new", F.coalesce((F.col("first") >= before).cast("int"), F.lit(0)))
    spans = spans.withColumn("_place", F.sum("_new").over(Window.partitionBy("rid", "long").orderBy("first", "end", "template")))
    most = F.max("share").over(Window.partitionBy("rid", "long", "_place"))
    span = F.when(F.col("real") & (~F.col("long") | (F.col("share") >= F.col("_most"))), F.struct(F.col("first").cast("long").alias("first"), (F.col("last") + F.least("size", F.lit(k)) - 1).cast("long").alias("last"), "label", F.col("share").alias("share")))
    return spans.withColumn("_most", most).groupBy("rid", "doc_id").agg(F.max("n_words").alias("n_words"), F.sort_array(F.collect_list(span)).alias("spans")).drop("rid")


def digest(scanned: DataFrame) -> DataFrame:
    """Per document: places of base phrases, labels, and a score: 1 for a whole notice, less for parts, half for base phrases alone."""
    base = F.filter("spans", lambda x: x["label"].isin(list(PHRASES)))
    names = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda x: x["label"]))), ",")
    worth = F.transform("spans", lambda x: F.when(x["label"].isin(list(PHRASES)), F.lit(0.5)).otherwise(F.least(x["share"], F.lit(1.0))))
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(F.transform(base, lambda x: x["first"])).alias("first_word"), F.array_max(F.transform(base, lambda x: x["first"])).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("spans")).alias("labels"), F.coalesce(F.array_max(worth), F.lit(0.0)).alias("score"),
    )

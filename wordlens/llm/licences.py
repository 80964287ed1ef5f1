"""License scans by diagonal voting, in DataFrame functions only.

The words of every text are hashed in rolling k-grams, which are joined to the positions of the
same k-grams in license templates (a fixed, small table, so its broadcast is bounded). A hit at word p of a
text and word t of a template lies on diagonal p - t; a copied license puts its hits on one diagonal, and
each inserted or dropped word moves the rest by one. Hits are aggregated by (text, template,
diagonal). From every diagonal on, its neighbours (each at most ``MAX_SHIFT`` from the one before, all within a template's length of the
first) are merged, and a merged span counts if its hits cover at least ``MIN_COVERAGE`` of the template's k-grams. A
notice that is repeated has diagonals in a chain of any length, of which each copy's own are a span.
The join compares the words themselves beside the hash, so hits are never collisions.

Base phrases (a few words each) are templates too, whose span must be whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K, MAX_SHIFT, MIN_COVERAGE = 3, 4, 0.6
#: ASCII bytes that are no lower-case letter or digit separate words (upper case is lowered before).
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Public license notices (opening or customary notice of each) and their labels.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu "
             "lesser general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("all-rights-reserved", "copyright all rights reserved"),
]


def templates(spark) -> DataFrame:
    """(template, is_base, label, grams, words, t, g0, g1, g2) for each k-gram position of each template; phrases of
    fewer than K words are one gram of two (g2 null)."""
    rows = []
    for n, (base, label, text) in enumerate([(True, v, k) for k, v in BASE.items()] + [(False, *x) for x in NOTICES]):
        ws = text.split()
        k = min(K, len(ws))
        for t in range(len(ws) - k + 1):
            gram = [*ws[t:t + k], None][:3]
            rows.append((n, base, label, len(ws) - k + 1, len(ws), t, *gram))
    return spark.createDataFrame(rows, "template int, is_base boolean, label string, grams int, words int, t int, "
                                       "g0 string, g1 string, g2 string")


def scan(docs: DataFrame, max_shift: int = MAX_SHIFT, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row of docs(doc_id, text).

    n_base counts the places of base phrases, first_word and last_word are their smallest and largest start
    (null if there are none), labels has the method's as well (distinct, sorted, comma-joined), score is
    the largest share of a template that a span covers. A null text is empty: no words, no labels ('').
    Repeated rows give repeated rows; null ids are carried; other columns are ignored; an empty table gives an
    empty one.

    One scan and one exchange of hits (a head row for each text, then only matching places), so the texts do not move.
    """
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    own = docs.select("doc_id", F.xxhash64("text").alias("th"),
                      F.array_remove(F.split(lowered, NOT_WORD), "").alias("w"))
    # each word with the two that follow; a text without words has one row, without a place
    some = F.greatest(F.size("w"), F.lit(1))
    zipped = own.select("doc_id", "th", F.size("w").alias("n_words"), F.arrays_zip(
        F.col("w").alias("w0"), F.slice("w", 2, some).alias("w1"), F.slice("w", 3, some).alias("w2")).alias("places"))
    rolled = zipped.select("doc_id", "th", "n_words", F.posexplode_outer("places").alias("pos", "g"))
    rolled = rolled.select("doc_id", "th", "n_words", "pos", "g.w0", "g.w1", "g.w2")
    # grams of a place: that of K words, of two where a short phrase may start, and a null for each text's head row
    firsts = sorted({k.split()[0] for k in BASE if len(k.split()) < K})
    whole, pair, none = F.xxhash64("w0", "w1", "w2"), F.xxhash64("w0", "w1"), F.lit(None).cast("bigint")
    head = F.coalesce(F.col("pos"), F.lit(0)) == 0
    grams = (F.when(head, F.array(whole, pair, none)).when(F.col("w0").isin(firsts), F.array(whole, pair))
             .otherwise(F.array(whole)))
    hashed = rolled.withColumn("gram", F.explode(grams))
    known = templates(docs.sparkSession).withColumn(
        "gram", F.when(F.col("g2").isNull(), F.xxhash64("g0", "g1")).otherwise(F.xxhash64("g0", "g1", "g2")))
    joined = hashed.join(F.broadcast(known), "gram", "left")  # a fixed table of under 200 rows
    same = ((F.col("w0") == F.col("g0")) & (F.col("w1") == F.col("g1"))
            & (F.col("g2").isNull() | (F.col("w2") == F.col("g2"))))
    heads = F.col("gram").isNull()
    hits = joined.where(heads | F.coalesce(same, F.lit(False)))
    text, template = ["doc_id", "th"], ["template", "is_base", "label", "grams", "words"]
    diagonals = hits.groupBy(*text, *template, (F.col("pos") - F.col("t")).alias("diagonal")).agg(
        F.collect_set("t").alias("ts"), F.min("pos").alias("start"),
        F.max("n_words").alias("n_words"), F.sum(heads.cast("int")).alias("copies"))
    by = Window.partitionBy(*text, "template").orderBy("diagonal")
    reach = F.when(F.col("is_base"), 0).otherwise(max_shift)
    apart = F.when(F.col("diagonal") - F.lag("diagonal").over(by) <= reach, 0).otherwise(1)
    chained = diagonals.withColumn("apart", apart).withColumn("chain", F.sum("apart").over(by))
    # what follows within the longest template's length, cut to the own template's
    ahead = (Window.partitionBy(*text, "template", "chain").orderBy("diagonal")
             .rangeBetween(Window.currentRow, max(len(t.split()) for _, t in NOTICES)))
    near = F.filter("following", lambda x: x["diagonal"] < F.col("diagonal") + F.col("words"))
    spans = chained.withColumn("following", F.collect_list(F.struct("diagonal", "ts")).over(ahead)).withColumn(
        "covered", F.size(F.array_distinct(F.flatten(F.transform(near, lambda x: x["ts"])))))
    coverage = F.col("covered") / F.col("grams")
    verified = F.when(F.col("is_base"), F.col("covered") == F.col("grams")).otherwise(coverage >= min_coverage)
    found = spans.where(F.col("template").isNull() | verified).withColumn("coverage", coverage)
    base = F.coalesce(F.col("is_base"), F.lit(False))
    result = found.groupBy(*text).agg(
        F.max("n_words").cast("bigint").alias("n_words"), F.sum(base.cast("bigint")).alias("n_base"),
        F.min(F.when(base, F.col("start").cast("bigint"))).alias("first_word"),
        F.max(F.when(base, F.col("start").cast("bigint"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"), F.sum("copies").alias("copies"))
    return result.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy", "copies", "th")

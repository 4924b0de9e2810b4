"""Licence notices in text, found by voting on diagonals.

Every run of GRAM words of a text is joined to the places where a template has the
same words. A hit votes for its diagonal, the word at which the template would begin.
Diagonals of one template that lie close together (a word more or less in between)
are merged, and a merged run counts if a stretch of it that is not much longer than
the template has most of its runs of words. All of it is column expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.frames import stored, text_of

GRAM = 3
#: Diagonals this close to the one before belong together.
SLACK = 3
#: Share of a notice's runs of words that must be there; all of them in a short one,
#: which may differ from another licence's by a word.
LEAST_SHARE = 0.7
SHORT = 12

# Phrases that must stand word for word, and their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Notices that licences ask for or that are commonly used, and their labels.
NOTICES = (
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files, to deal in the software without restriction",
    ),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except"
        " in compliance with the License",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met",
    ),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License"
        " as published by the Free Software Foundation",
    ),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License"),
    (
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted",
    ),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "All rights reserved"),
)

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


#: Words of the longest notice.
_LONGEST = max(len([word for word in re.split(_BREAK, text.lower()) if word]) for _, text in NOTICES)


def _templates(spark: SparkSession) -> DataFrame:
    """Rows of template, label, base, length and place, and the words from that place on.

    Fixed lists: a few hundred rows.
    """
    rows = []
    texts = [(True, *one) for one in PHRASES] + [(False, *one) for one in NOTICES]
    for number, (base, label, text) in enumerate(texts):
        words = [word for word in re.split(_BREAK, text.lower()) if word]
        for place in range(len(words) - GRAM + 1):
            rows.append((number, label, base, len(words), place, *words[place : place + GRAM]))
    kind = "template int, label string, base boolean, length int, place int, t1 string, t2 string, t3 string"
    return spark.createDataFrame(rows, kind).withColumn("gram", F.xxhash64("t1", "t2", "t3"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z made small. n_base counts
    the places where a phrase stands word for word; first_word and last_word are the
    smallest and largest of their starts, else null. base_labels are the phrases'
    labels, labels also those of the notices found; both are sorted arrays without
    repeats. score is the largest share found of any template, 1 for a phrase, 0 for no label. One row per
    input row, repeated rows included. A null or wordless text has no words and no
    labels. Other columns are not read.
    """
    own, text = F.col(f"`{id_col}`"), text_of(text_col)
    plain = F.octet_length(text) == F.length(text)
    small = F.when(plain, F.lower(text)).otherwise(F.translate(text, _CAPITALS, _CAPITALS.lower()))
    words = F.array_remove(F.split(small, _BREAK), "")
    rows = docs.select(own.alias("id"), F.xxhash64(own, text).alias("row_key"), words.alias("w"))

    # Runs of three words, hashed, against the templates' few hundred.
    shifted = [F.col("w"), F.expr("slice(w, 2, size(w))"), F.expr("slice(w, 3, size(w))")]
    named = [column.alias(name) for column, name in zip(shifted, ("w1", "w2", "w3"))]
    each = rows.filter(f"size(w) >= {GRAM}").select("row_key", F.posexplode(F.arrays_zip(*named)).alias("at", "g"))
    each = each.select("row_key", "at", "g.w1", "g.w2", "g.w3")
    each = each.withColumn("gram", F.xxhash64("w1", "w2", "w3"))
    hits = each.join(F.broadcast(_templates(docs.sparkSession)), "gram")
    hits = hits.filter("w1 = t1 AND w2 = t2 AND w3 = t3")
    hits = hits.select(
        "row_key", "template", "label", "base", "length", "place", "at", (F.col("at") - F.col("place")).alias("diagonal")
    )
    hits = stored(hits.distinct())

    notices = hits.filter("NOT base")
    votes = notices.groupBy("row_key", "template", "diagonal").agg(F.count("*").alias("votes"))
    in_order = Window.partitionBy("row_key", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(in_order)
    fresh = F.when(apart <= SLACK, 0).otherwise(1)
    runs = votes.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(in_order))
    runs = runs.select("row_key", "template", "diagonal", "run")

    # A phrase stands where its diagonal has all its runs of words.
    exact = hits.filter("base").groupBy("row_key", "template", "label", "length", "diagonal").count()
    exact = exact.filter(f"count = length - {GRAM - 1}").groupBy("row_key").agg(
        F.count("*").alias("n_base"),
        F.min("diagonal").cast("long").alias("first_word"),
        F.max("diagonal").cast("long").alias("last_word"),
        F.sort_array(F.collect_set("label")).alias("base_labels"),
    )
    # Of a notice, the places seen from each hit on in twice its length: at most so many hits.
    ahead = (
        Window.partitionBy("row_key", "template", "run")
        .orderBy("at")
        .rangeBetween(0, 2 * _LONGEST - GRAM)
    )
    merged = notices.join(runs, ["row_key", "template", "diagonal"])
    merged = merged.withColumn("near", F.collect_list(F.struct("at", "place")).over(ahead))
    stretch = F.expr(
        f"size(array_distinct(transform(filter(near, h -> h.at <= at + 2 * length - {GRAM}), h -> h.place)))"
    )
    merged = merged.withColumn("stretch", stretch).groupBy(
        "row_key", "template", "label", "length", "run"
    ).agg(F.max("stretch").alias("seen"))
    share = F.col("seen") / (F.col("length") - (GRAM - 1))
    merged = merged.withColumn("share", share).filter(
        F.col("share") >= F.when(F.col("length") < SHORT, 1.0).otherwise(LEAST_SHARE)
    )
    found = merged.groupBy("row_key").agg(
        F.collect_set("label").alias("noticed"),
        F.max("share").alias("score"),
    )
    found = exact.join(found, "row_key", "full")

    none = F.array().cast("array<string>")
    out = rows.select("id", "row_key", F.size("w").cast("long").alias("n_words")).join(found, "row_key", "left")
    base_labels = F.coalesce("base_labels", none)
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        base_labels.alias("base_labels"),
        F.sort_array(F.array_union(base_labels, F.coalesce("noticed", none))).alias("labels"),
        F.when(F.col("n_base").isNotNull(), 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"),
    )

"""Licence texts in documents, found by an exact set-similarity join of text blocks with templates."""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm.storage import stored

#: Share of a template's tokens that a block has to hold.
THRESHOLD = 0.8

# What separates words, the phrases of the base, and the wording of notices. Letters are
# all other characters once A-Z are lower-cased; Java is ten times slower on a class that negates.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_LETTER = r"[0-9a-z\x80-\x{10FFFF}]"
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl-2", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("lgpl-3", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
]


def tokens(text: str) -> list[str]:
    """Distinct pairs of neighbouring words of a template, in order."""
    words = text.split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


#: Words from one block to the next; a block has twice as many, so each notice lies whole in one.
STEP = max(len(text.split()) for _, text in TEMPLATES)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"{_LETTER}+"), F.lit(0))


def _template_tokens(spark: SparkSession, threshold: float) -> DataFrame:
    """(template, label, size, need, token): a row for each token of each template."""
    each = [
        F.struct(
            F.lit(k).alias("template"), F.lit(label).alias("label"), F.lit(len(own)).alias("size"),
            F.lit(math.ceil(threshold * len(own) - 1e-9)).alias("need"), F.array(*map(F.lit, own)).alias("tokens"),
        )
        for k, (label, text) in enumerate(TEMPLATES)
        for own in (tokens(text),)
    ]
    rows = spark.range(1).select(F.inline(F.array(*each)))
    return rows.select("template", "label", "size", "need", F.explode("tokens").alias("token"))


def _read(docs: DataFrame) -> DataFrame:
    """Words, places of the phrases, and the places of tokens that some template holds, for each row."""
    vocabulary = sorted({t for _, text in TEMPLATES for t in tokens(text)})
    firsts = sorted({t.split()[0] for t in vocabulary})
    small = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), small.alias("text")
    )
    rows = rows.withColumn("words", _words(F.col("text")))
    first, last, number, labels = [], [], [], []
    for label, phrase in PHRASES.items():
        own = f"(?<!{_LETTER})" + f"{_GAP}+".join(phrase.split()) + f"(?!{_LETTER})"
        rows = rows.withColumn(label, F.when(F.col("text").rlike(own), F.split("text", own, -1)))
        part = F.col(f"`{label}`")
        n = F.coalesce(F.size(part) - 1, F.lit(0))
        found = part.isNotNull()
        number.append(n)
        labels.append(F.when(found, F.lit(label)))
        first.append(F.when(found, F.size(_words(part[0]))))
        last.append(F.when(found, F.size("words") - F.size(_words(F.element_at(part, -1))) - len(phrase.split())))
    size = F.size("words")
    here = F.transform("words", lambda w, k: F.when(w.isin(firsts) & (k + 1 < size), k))
    rows = rows.withColumn("here", F.filter(here, lambda k: k.isNotNull()))
    pair = F.transform(
        "here", lambda k: F.struct(k.alias("place"), F.concat(F.col("words")[k], F.lit(" "), F.col("words")[k + 1]).alias("token"))
    )
    return rows.select(
        "row", "doc_id", size.cast("long").alias("n_words"), sum(number).cast("long").alias("n_base"),
        F.least(*first).cast("long").alias("first_word"), F.greatest(*last).cast("long").alias("last_word"),
        F.array_sort(F.array_compact(F.array(*labels))).alias("base"),
        F.filter(pair, lambda x: x["token"].isin(vocabulary)).alias("found"),
    )


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row.

    Words are lower-cased runs of letters, digits and characters beyond ASCII. Base: places where
    the words of a phrase stand one after the other. Beyond it, a block of text gets the label of
    each template of which it holds at least ``threshold`` of the tokens, pairs of neighbouring
    words. A block has 2 * STEP words and begins every STEP words, so any notice as long as a
    template lies whole in one. ``score`` is 1 where the base found a place, else the greatest share
    of a template that a block holds, 0 where no template is found.

    Join: tokens are ordered by the number of blocks that hold them, the rarest first. A block and a template
    that meet the threshold share one of the template's first tokens (prefix filter), the block is
    long enough (length filter), and what follows the shared token in both suffices (positional filter); those
    that pass are intersected. Tokens of no template are left where the text is read, so only
    a few places of each text are moved, and never its text.

    Null and empty texts have no words: zeros, null places, empty labels. Null and repeated ids
    stay, a row for each row. Other columns are ignored. No rows give no rows.
    """
    spark = docs.sparkSession
    rows = stored(_read(docs), "license_places")
    places = rows.select("row", "n_words", F.inline("found"))
    block = F.floor(F.col("place") / STEP).cast("long")
    blocks = places.select("row", "n_words", "token", F.explode(F.array(block, block - 1)).alias("block"))
    blocks = blocks.where("block >= 0").distinct()
    # As many rows as the templates have tokens, so one task orders them.
    templates = _template_tokens(spark, threshold)
    frequency = blocks.groupBy("token").agg(F.count("*").alias("n"))
    order = templates.select("token").distinct().join(frequency, "token", "left").select(
        "token", F.row_number().over(Window.orderBy(F.coalesce("n", F.lit(0)), "token")).alias("rank")
    )
    order = stored(order, "license_order")
    templates = (
        templates.join(F.broadcast(order), "token")
        .groupBy("template", "label", "size", "need")
        .agg(F.array_sort(F.collect_list("rank")).alias("own"))
    )
    prefix = templates.select("*", F.posexplode("own").alias("at", "rank")).where(F.col("at") <= F.col("size") - F.col("need"))
    sets = (
        blocks.join(F.broadcast(order), "token")
        .groupBy("row", "block")
        .agg(F.array_sort(F.collect_list("rank")).alias("held"), F.first("n_words").alias("n_words"))
    )
    long = F.least(F.lit(2 * STEP), F.col("n_words") - 1 - F.col("block") * STEP)
    candidates = sets.select("row", "held", long.alias("long"), F.posexplode("held").alias("held_at", "rank")).join(
        F.broadcast(prefix), "rank"
    )
    candidates = candidates.where(
        (F.col("long") >= F.col("need"))
        & (F.least(F.col("size") - F.col("at"), F.size("held") - F.col("held_at")) >= F.col("need"))
    )
    share = F.size(F.array_intersect("held", "own"))
    found = (
        candidates.select("row", "label", "need", "size", share.alias("share"))
        .where(F.col("share") >= F.col("need"))
        .groupBy("row")
        .agg(F.collect_set("label").alias("more"), F.max(F.col("share") / F.col("size")).alias("most"))
    )
    none = F.array().cast("array<string>")
    return rows.drop("found").join(found, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.concat_ws(",", "base").alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("base", F.coalesce("more", none)))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"),
    )

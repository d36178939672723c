"""License notices in texts, found by voting on the diagonals of word k-gram matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from oreflow.llm.common import lower_ascii

#: What stands between words, after A-Z became a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases that give a label wherever their words stand one after the other.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# The wording of public license notices; a text that has most of one gets its label.
NOTICES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
        "not distributed with this file you can obtain one at",
    ),
    (
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify "
        "publish use compile sell or distribute this software",
    ),
)
GRAM = 4
#: Diagonals this near are one passage (words put in or left out); part of a notice that must match.
SLACK, COVERAGE = 3, 0.6


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _templates(phrases: dict[str, str], notices: tuple[tuple[str, str], ...]) -> list[tuple]:
    """``(template, label, is phrase, gram size, grams, position, gram)`` for all grams of all templates."""
    rows = []
    for i, (label, text, phrase) in enumerate(
        [*((v, k, True) for k, v in phrases.items()), *((a, b, False) for a, b in notices)]
    ):
        words = text.split()
        k = 2 if phrase else GRAM
        n = len(words) - k + 1
        rows += [(i, label, phrase, k, n, at, " ".join(words[at : at + k])) for at in range(n)]
    return rows


def _lookup(spark: SparkSession, rows: list[tuple], k: int) -> DataFrame:
    """All places of each gram of ``k`` words by the gram's hash; a few hundred rows, fixed above."""
    schema = "template int, label string, phrase boolean, k int, grams int, at int, gram string"
    table = spark.createDataFrame([r for r in rows if r[3] == k], schema)
    parts = F.split("gram", " ")
    hashed = table.withColumn(f"h{k}", F.xxhash64(*[parts[i] for i in range(k)]))
    return hashed.groupBy(f"h{k}").agg(
        F.collect_list(F.struct("template", "label", "phrase", "grams", "at", "gram")).alias(f"hits{k}")
    )


def license_scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    notices: tuple[tuple[str, str], ...] = NOTICES,
    coverage: float = COVERAGE,
) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``text``): places of phrases, labels and a score.

    All rolling k-grams of a text's words (2 words for phrases, 4 for notices) are joined by hash to
    the templates' grams and compared as text.  A match votes for its diagonal, text position less
    template position.  A phrase stands where a diagonal has all its votes.  For notices,
    neighbouring diagonals are merged into one passage, which counts if it has at least ``coverage``
    of the template's grams, each counted once, within a span of at most twice its length.

    ``n_words``, ``n_base`` (places of phrases), ``first_word`` and ``last_word`` (first and last such
    place, else null), ``base_labels``, ``labels`` (sorted, comma-joined), ``score`` (the best
    coverage of any template by one passage, 1 for a phrase), ``passages`` (label, first and last word,
    coverage of each confirmed notice).  A null or empty text has no words, no labels and score 0.
    Rows that repeat are judged each for itself.
    """
    spark = docs.sparkSession
    rows = _templates(phrases, notices)
    two, four = _lookup(spark, rows, 2), _lookup(spark, rows, GRAM)
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("w"))
    size = F.size("w")
    tail = [F.slice("w", i + 1, F.greatest(size - i, F.lit(0))).alias(f"w{i}") for i in range(1, GRAM)]
    zipped = F.arrays_zip(F.col("w").alias("w0"), *tail)
    grams = texts.select("row", "doc_id", size.cast("long").alias("n_words"), F.posexplode_outer(zipped).alias("pos", "g"))
    w = [F.col("g")[f"w{i}"] for i in range(GRAM)]
    grams = grams.select(
        "row",
        "doc_id",
        "n_words",
        "pos",
        *[x.alias(f"w{i}") for i, x in enumerate(w)],
        F.when(w[1].isNotNull(), F.xxhash64(*w[:2])).alias("h2"),
        F.when(w[-1].isNotNull(), F.xxhash64(*w)).alias(f"h{GRAM}"),
    )
    # The lookups have as many rows as the constants above have words: a bound that no data moves.
    matched = grams.join(F.broadcast(two), "h2", "left").join(F.broadcast(four), f"h{GRAM}", "left")
    found = F.col("hits2").isNotNull() | F.col(f"hits{GRAM}").isNotNull()
    # The first word of a text stays, so that every row of docs is still there after the sums.
    matched = matched.where(found | F.col("pos").isNull() | (F.col("pos") == 0))
    none = F.array().cast(two.schema["hits2"].dataType)
    both = F.concat(F.coalesce("hits2", none), F.coalesce(f"hits{GRAM}", none))
    votes = matched.select(
        "row", "doc_id", "n_words", "pos", *[f"w{i}" for i in range(GRAM)], F.explode_outer(both).alias("hit")
    )
    text = F.when(F.col("hit.phrase"), F.concat_ws(" ", "w0", "w1")).otherwise(
        F.concat_ws(" ", *[f"w{i}" for i in range(GRAM)])
    )
    right = F.col("hit").isNotNull() & (text == F.col("hit.gram"))
    good = lambda c: F.when(right, F.col(f"hit.{c}"))
    votes = votes.select(
        "row",
        "doc_id",
        "n_words",
        *[good(c).alias(c) for c in ("template", "label", "phrase", "grams", "at")],
        F.when(right, F.col("pos")).alias("pos"),
    )
    key = ["row", "doc_id", "n_words", "template"]
    diagonals = (
        votes.withColumn("diagonal", F.col("pos") - F.col("at"))
        .groupBy(*key, "diagonal")
        .agg(
            *[F.first(c, ignorenulls=True).alias(c) for c in ("label", "phrase", "grams")],
            # At most as many as the template has grams.
            F.collect_set("at").alias("ats"),
            F.min("pos").alias("lo"),
            F.max("pos").alias("hi"),
        )
    )
    order = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > F.when(F.col("phrase"), 0).otherwise(SLACK)
    passages = diagonals.withColumn("part", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(order))
    passages = passages.groupBy(*key, "label", "phrase", "grams", "part").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("votes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("diagonal").alias("at")
    )
    part = F.when(F.col("votes") > 0, F.least(F.col("votes") / F.col("grams"), F.lit(1.0)))
    passages = passages.withColumn("part_matched", part)
    base = F.col("phrase") & (F.col("votes") == F.col("grams"))
    whole = ~F.col("phrase") & (part >= coverage) & (F.col("hi") - F.col("lo") <= 2 * (F.col("grams") + GRAM))
    span = F.struct("label", "lo", (F.col("hi") + GRAM - 1).alias("hi"), F.col("part_matched").alias("coverage"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("label")))), ",")
    return passages.groupBy("row", "doc_id", "n_words").agg(
        F.sum(F.coalesce(base, F.lit(False)).cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("at"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("at"))).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(base | whole).alias("labels"),
        F.coalesce(F.max("part_matched"), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(whole, span))).alias("passages"),
    ).drop("row")



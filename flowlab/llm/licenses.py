"""License scans by diagonal voting, in DataFrame functions alone.

Every k consecutive words of every document meet the places of the same words in license templates, by an equi-join on
their hash (the words themselves are compared too, so a hash that two grams share adds nothing). Where the templates have
few words, words that stand nowhere in them make no grams. A meeting of document
place x and template place y votes for the diagonal x - y: a template that stands in a text unbroken puts all its votes on
one diagonal, words added or left out move the rest to a diagonal close by. Votes are summed by diagonal, neighbouring
diagonals of one template are merged into a span, and a span is verified by the share of the template's words in it.

Phrases are short templates that count only word for word: they allow no neighbouring diagonals and need all of their
votes. Notices may lose or gain words.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
#: Words in a gram of a phrase and of a notice.
PHRASE_GRAM, NOTICE_GRAM = 2, 4
#: Diagonals of a notice at most this far apart belong to one span.
NEIGHBOURS = 8
#: Share of a notice's words that its span must hold.
NEEDED = 0.6
#: Rows of templates up to which they are broadcast.
BROADCAST_ROWS = 100_000
#: Words of templates up to which a text's grams are sifted by them before they are made.
SET_WORDS = 5_000

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Passages of well-known license notices.
NOTICES = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
    "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software": "mit",
    "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0": "apache",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version": "gpl",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met": "bsd",
}


def words_of(text: str | Column) -> Column:
    """Words of a text, A-Z in lower case; none for null."""
    lower = F.translate(text, UPPER, LOWER)
    return F.coalesce(F.regexp_extract_all(lower, F.lit(WORDS), F.lit(1)), F.array().cast("array<string>"))


def grams(words: str, k: int) -> Column:
    """Each ``k`` consecutive words of a column, with blanks between them; none if there are fewer."""
    parts = lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + j) for j in range(1, k)])
    last = F.size(words) - k + 1
    return F.when(last > 0, F.slice(F.transform(words, parts), F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<string>"))


def templates(
    spark: SparkSession, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES
) -> DataFrame:
    """``template, label, exact, length, place, gram, gram_hash``: a row for each gram of each template."""
    given = [(text, label, True) for text, label in phrases.items()] + [(text, label, False) for text, label in notices.items()]
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(exact).alias("exact"), F.lit(text).alias("text"))
        for i, (text, label, exact) in enumerate(given)
    ]))
    table = spark.range(1).select(rows.alias("t")).select("t.template", "t.label", "t.exact", words_of("t.text").alias("words"))
    own = F.when(F.col("exact"), grams("words", PHRASE_GRAM)).otherwise(grams("words", NOTICE_GRAM))
    table = table.select("template", "label", "exact", F.size("words").alias("length"), F.posexplode(own).alias("place", "gram"))
    return table.withColumn("gram_hash", F.xxhash64("gram"))


def word_sets(marks: DataFrame) -> dict[bool, list[list[str]]] | None:
    """For phrases (True) and notices (False) the words that stand first, second, ... in any gram of a template. None if
    they are too many to be written into a condition."""
    if marks.count() > BROADCAST_ROWS:
        return None
    parts = F.split("gram", " ")
    sets = marks.groupBy("exact").agg(*[F.collect_set(F.get(parts, F.lit(i))).alias(f"w{i}") for i in range(NOTICE_GRAM)])
    if sets.agg(F.coalesce(F.sum(sum(F.size(f"w{i}") for i in range(NOTICE_GRAM))), F.lit(0))).first()[0] > SET_WORDS:
        return None
    found = {r.exact: [r[f"w{i}"] for i in range(PHRASE_GRAM if r.exact else NOTICE_GRAM)] for r in sets.collect()}
    return {exact: found.get(exact, [[]]) for exact in (True, False)}


def gram_rows(docs: DataFrame, id_column: str, text_column: str, known: Mapping[bool, Sequence[Sequence[str]]] | None = None) -> DataFrame:
    """``id, digest, n_words, at, gram``: the grams of each document. A document has an empty gram, too, at -1, so that
    one without any is not lost. Documents of one id are told apart by the digest of their text. With ``known`` (see
    ``word_sets``) only grams that may be a template's: each of their words is known at its place."""
    words = docs.select(F.col(id_column).alias("id"), F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("digest"), words_of(text_column).alias("words"))

    def places(k: int, sets: Sequence[Sequence[str]] | None) -> Column:
        if sets is None:
            last = F.size("words") - k
            return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))

        def may_be(i: Column) -> Column:
            # Most places end at the first of these.
            found = F.get("words", i).isin(list(sets[0]))
            for j, names in enumerate(sets[1:], 1):
                found = found & F.get("words", i + j).isin(list(names))
            return found

        return F.filter(F.sequence(F.lit(0), F.size("words") - 1), may_be)

    def marked(k: int, exact: bool) -> Column:
        return F.transform(places(k, known and known[exact]), lambda i: F.struct(i.alias("at"), F.lit(k).alias("k")))

    own = F.array(F.struct(F.lit(-1).alias("at"), F.lit(0).alias("k")))
    rows = words.select(
        "id", "digest", "words", F.size("words").cast("long").alias("n_words"),
        F.explode(F.concat(own, marked(PHRASE_GRAM, True), marked(NOTICE_GRAM, False))).alias("p"),
    )
    gram = lambda k: F.concat_ws(" ", *[F.get("words", F.col("p.at") + j) for j in range(k)])
    text = F.when(F.col("p.k") == 0, F.lit("")).when(F.col("p.k") == PHRASE_GRAM, gram(PHRASE_GRAM)).otherwise(gram(NOTICE_GRAM))
    return rows.select("id", "digest", "n_words", F.col("p.at").cast("long").alias("at"), text.alias("gram"))


def votes(docs: DataFrame, marks: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, digest, n_words, template, label, exact, length, diagonal, place`` and ``copies``, the number of documents
    of that id and text: one row for each vote, and one with a null template for each document."""
    own = docs.sparkSession.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in marks.schema if f.name not in ("gram", "gram_hash")], F.lit("").alias("gram")
    ).withColumn("gram_hash", F.xxhash64("gram"))
    goals = marks.unionByName(own)
    if marks.count() <= BROADCAST_ROWS:
        goals = F.broadcast(goals)
    rows = gram_rows(docs, id_column, text_column, word_sets(marks)).withColumn("gram_hash", F.xxhash64("gram"))
    met = rows.join(goals, ["gram_hash", "gram"])
    keys = ["id", "digest", "n_words", "template", "label", "exact", "length"]
    # Equal documents are summed in their tasks first.
    return met.groupBy(*keys, (F.col("at") - F.col("place")).alias("diagonal"), "place").agg(F.count("*").alias("copies"))


def _merged(votes: DataFrame) -> DataFrame:
    """Votes summed by diagonal and diagonals of a template that lie close together made one; the row that each document
    has without a template stays a row."""
    keys = ["id", "digest", "template"]
    facts = [F.first(c).alias(c) for c in ("n_words", "label", "exact", "length")]
    # All that follows groups by document: one shuffle of the few votes, equal documents counted before it.
    by_diagonal = votes.repartition("id", "digest").groupBy(*keys, "diagonal").agg(
        *facts, F.first("copies").alias("copies"), F.collect_set("place").alias("places")
    )
    before = Window.partitionBy(*keys).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(before) > F.when(F.col("exact"), 0).otherwise(NEIGHBOURS)
    band = F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(before.rowsBetween(Window.unboundedPreceding, 0))
    return by_diagonal.withColumn("band", band).groupBy(*keys, "band").agg(
        *facts, F.first("copies").alias("copies"),
        F.min(F.col("diagonal") + F.array_min("places")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("places")).alias("last"),
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
    )


def _verified(merged: DataFrame) -> DataFrame:
    """Adds ``end`` and ``share``; a share that is not enough is null."""
    k = F.when(F.col("exact"), PHRASE_GRAM).otherwise(NOTICE_GRAM)
    words = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + k - 1))))
    share = F.size(words) / F.col("length")
    needed = F.when(F.col("exact"), 1.0).otherwise(NEEDED)
    return merged.withColumn("end", F.col("last") + k).withColumn("share", F.when(share >= needed, share))


def spans(votes: DataFrame) -> DataFrame:
    """``id, digest, template, label, exact, start, end, share`` of every verified span, words numbered from 0, ``end``
    behind the last one."""
    return _verified(_merged(votes)).filter("share is not null").select(
        "id", "digest", "template", "label", "exact", "start", "end", "share"
    )


def scanned(docs: DataFrame, marks: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``<id>, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row of ``docs``.

    ``n_base`` counts the places of phrases, ``first_word`` and ``last_word`` are the smallest and largest word at which one
    starts (null without any). Labels are distinct and sorted; ``labels`` also holds those of notices. ``score`` is the
    largest share of a template that a span holds, 0 without one. A null or empty text has no words; a row that is
    repeated comes back as often; other columns are ignored; no documents give no rows.
    """
    found = _verified(_merged(votes(docs, marks, id_column, text_column)))
    held = F.col("share").isNotNull()
    base = held & F.col("exact")
    labels = lambda which: F.concat_ws(",", F.array_sort(F.collect_set(F.when(which, F.col("label")))))
    rows = found.groupBy("id", "digest").agg(
        F.first("n_words").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(held).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        F.max(F.when(F.col("template").isNull(), F.col("copies"))).alias("copies"),
    )
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return rows.select(F.col("id").alias(id_column), *names, copy).drop("copy")

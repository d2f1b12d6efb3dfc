"""License scan: an exact set-similarity join of text blocks with license templates.

Every run of ``BLOCK_WORDS`` words is a block, one at each word.  A block meets a template when
it holds at least ``threshold`` of the template's distinct words.  The join is exact:

* words are ordered by how many documents hold them, rarest first, over the whole table;
* prefix filter: a block that meets a template of n words, at least r = ceil(threshold n)
  of them, holds one of its n - r + 1 rarest words; other texts are not cut into words at all;
* length and positional filter: a text and template go on only if the text holds r of the
  template's words, and no more than n - i can be shared where the rarest held one stands at
  place i (from 0) of the template's order.

The words of what is left are joined with the table of template words.  A word that stands at
place p is the first of its kind in the blocks that start after its last occurrence and not
over a block's length before p; these stretches, one per occurrence and never overlapping for
one word, are added up along the text.  So every block is verified, without building any, and
the work is that of the words and not of the blocks.  All of it is DataFrame expressions.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardledger.llm.common import free_name, stored, whole_text

# Phrases and the labels they give.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Longer license wording, by label: public first sentences of the licenses.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "apache-2": "licensed under the apache license version 2 0 you may not use this file except in compliance",
    "gpl": "this program is free software you can redistribute it under the terms of the gnu general public license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by": "this work is licensed under a creative commons attribution license",
    "cc-by-nc": "licensed under cc by nc 4 0",
}
THRESHOLD = 0.8
BLOCK_WORDS = 32

_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    plain = F.trim(F.regexp_replace(text, _SEPARATOR, " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(
        F.split(F.translate(plain, _UPPER, _UPPER.lower()), " ")
    )


def word_order(docs: DataFrame, templates: Mapping[str, str], text_column: str = "text") -> dict[str, int]:
    """How many documents hold each word of the templates: one scan, a row per template word."""
    vocabulary = sorted({w for text in templates.values() for w in text.split()})
    held = F.array_intersect(words_of(whole_text(text_column)), F.array(*map(F.lit, vocabulary)))
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").count().collect()
    found = {r["word"]: r["count"] for r in counts}
    return {w: found.get(w, 0) for w in vocabulary}


_PLACES = "array<struct<at:int,label:string>>"
_RUN = "struct<first_word:int,blocks:int,label:string,containment:double>"


def _places(words: Column, n: Column, phrase: str, label: str) -> Column:
    """Where the words of a phrase stand consecutively."""
    parts = phrase.split()
    wanted = F.array(*map(F.lit, parts))
    every = F.sequence(F.lit(0), F.greatest(n - len(parts), F.lit(0)))
    here = F.filter(every, lambda at: F.slice(words, at + 1, len(parts)) == wanted)
    return F.transform(here, lambda at: F.struct(at.alias("at"), F.lit(label).alias("label")))


def template_words(docs: DataFrame, templates: Mapping[str, str], threshold: float, order: Mapping[str, int]) -> DataFrame:
    """(word, uses): the templates that hold a word, each with its place in the template's order, its size and its need."""
    rows = []
    for label, text in templates.items():
        words = sorted(set(text.split()), key=lambda w: (order.get(w, 0), w))
        need = math.ceil(threshold * len(words) - 1e-9)
        rows += [(word, label, place, len(words), need) for place, word in enumerate(words)]
    table = docs.sparkSession.createDataFrame(rows, "word string, label string, place int, size int, need int")
    return table.groupBy("word").agg(F.collect_list(F.struct("label", "place", "size", "need")).alias("uses"))


def _runs(words: DataFrame) -> DataFrame:
    """(row, first_word, blocks, label, containment): runs of blocks that meet a template, equal in what they share.

    Given are the template words of every text: row, place in it, n_words, and use (label, place, size, need).
    """
    used = words.select("row", "n_words", F.col("place").alias("at"), F.inline("uses"))
    # Prefix, length and positional filter.
    fit = (
        used.groupBy("row", "label", "size", "need")
        .agg(F.count_distinct("place").alias("held"), F.min("place").alias("rarest"))
        .filter((F.col("held") >= F.col("need")) & (F.col("size") - F.col("rarest") >= F.col("need")))
        .select("row", "label")
    )
    used = used.join(stored(fit, "license-pairs"), ["row", "label"], "left_semi")
    before = F.lag("at").over(Window.partitionBy("row", "label", "place").orderBy("at"))
    last_block = F.greatest(F.col("n_words") - BLOCK_WORDS, F.lit(0))
    first = F.greatest(F.col("at") - (BLOCK_WORDS - 1), F.coalesce(before + 1, F.lit(0)), F.lit(0))
    stretches = used.select("row", "label", "size", "need", first.alias("first"), (F.least("at", last_block) + 1).alias("end"))
    steps = stretches.filter("first < end").select(
        "row", "label", "size", "need",
        F.explode(F.array(F.struct(F.col("first").alias("at"), F.lit(1).alias("step")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("step")))).alias("s"),
    )
    steps = steps.groupBy("row", "label", "size", "need", "s.at").agg(F.sum("s.step").alias("step"))
    along = Window.partitionBy("row", "label").orderBy("at")
    return (
        steps.withColumn("shared", F.sum("step").over(along))
        .withColumn("end", F.lead("at").over(along))
        .filter(F.col("shared") >= F.col("need"))
        .select(
            "row",
            F.col("at").alias("first_word"),
            (F.col("end") - F.col("at")).alias("blocks"),
            "label",
            (F.col("shared") / F.col("size")).alias("containment"),
        )
    )


def license_scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    phrases: Mapping[str, str] = PHRASES,
    text_column: str = "text",
    order: Mapping[str, int] | None = None,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``docs``, all by default, with ``license``: n_words, n_base, first_word, last_word, base_labels, labels, score, blocks.

    ``n_base`` counts the places of the phrases, with the smallest and largest start (words
    from 0).  ``blocks`` lists what the join found, as runs of blocks that start word by word:
    first_word, blocks (how many), label, containment.  ``labels`` joins the labels of both;
    ``score`` is the best containment found, 1 for a phrase, else 0.  Null and empty texts have
    no words and no labels.  Repeated rows are each scanned.  Other columns are kept as they
    are; ``license`` gets underscores where taken.
    """
    order = word_order(docs, templates, text_column) if order is None else order
    keep = tuple(docs.columns) if keep is None else keep
    vocabulary = stored(template_words(docs, templates, threshold, order), "license-words")
    prefixes = sorted(
        r["word"] for r in vocabulary.filter(F.exists("uses", lambda u: u["place"] <= u["size"] - u["need"])).collect()
    )
    words = F.col("words")
    n = F.size(words)
    starts = F.array().cast(_PLACES)
    joined = F.array_join(words, " ")
    for phrase, label in phrases.items():
        # Only texts with the phrase are searched word by word.
        holds = F.contains(joined, F.lit(phrase)) & (n >= len(phrase.split()))
        starts = F.concat(starts, F.when(holds, _places(words, n, phrase, label)).otherwise(F.array().cast(_PLACES)))
    # One scan: a text's first row, its head, carries what is kept of it; the others are template words.
    some = F.arrays_overlap(words, F.array(*map(F.lit, prefixes))) if prefixes else F.lit(False)
    cut = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in keep] or [F.lit(None).cast("int").alias("nothing")]).alias("kept"),
        words_of(whole_text(text_column)).alias("words"),
    ).select("row", "kept", "words", n.alias("n_words"), starts.alias("starts"), F.when(some, words).alias("searched"))
    placed = cut.select("row", "kept", "n_words", "starts", F.posexplode_outer("searched").alias("place", "word"))
    head = F.coalesce(F.col("place"), F.lit(0)) == 0
    placed = placed.join(vocabulary, "word", "left").filter(F.col("uses").isNotNull() | head)
    placed = stored(
        placed.select(
            "row", "place", "n_words", "uses", head.alias("head"), F.when(head, F.col("kept")).alias("kept"), F.when(head, F.col("starts")).alias("starts")
        ),
        "license-places",
    )
    runs = _runs(placed.filter("uses IS NOT NULL"))
    found = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("first_word", F.col("blocks").cast("int").alias("blocks"), "label", "containment"))).alias("blocks"))
    heads = placed.filter("head").select("row", "kept", "n_words", "starts").join(found, "row", "left")
    starts, blocks = F.col("starts"), F.coalesce("blocks", F.array().cast(f"array<{_RUN}>"))
    base = F.array_sort(F.array_distinct(F.transform(starts, lambda s: s["label"])))
    every = F.array_sort(F.array_distinct(F.concat(base, F.transform(blocks, lambda b: b["label"]))))
    score = F.when(F.size(starts) > 0, F.lit(1.0)).otherwise(
        F.coalesce(F.array_max(F.transform(blocks, lambda b: b["containment"])), F.lit(0.0))
    )
    found = F.struct(
        F.col("n_words").cast("long").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(F.transform(starts, lambda s: s["at"])).cast("long").alias("first_word"),
        F.array_max(F.transform(starts, lambda s: s["at"])).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        score.alias("score"),
        blocks.alias("blocks"),
    )
    name = free_name(docs.select(*[F.col(f"`{c}`") for c in keep]), "license")
    return heads.select(*[F.col(f"kept.`{c}`").alias(c) for c in keep], found.alias(name))

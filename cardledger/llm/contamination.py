"""Benchmark decontamination with a distributed positional inverted index.

Index: a posting (document row, place, term) for every word of the training documents that
some test item uses, written as a table where the documents lie; no posting is moved.  With
``vocabulary=None`` all words are kept, for test items of another day.

Test items are cut into windows of consecutive words.  A window's places are ranked by how
often their term occurs in the index, rarest first.  Its matches are found by intersecting
posting lists, each moved back by the term's place in the window, so that lists of one match
meet in one number, the place where the window starts:

* the list of the rarest term gives the candidates;
* the list of the second rarest thins them out, read for the terms of that rank only;
* the lists of all other places must agree with what is left, read for the documents left only.

Proximity matches use the same lists without the offsets: every term of the window stands at
most ``reach`` words from a place of its rarest one.  Windows with a word that no document
holds are never looked for.  All of it is DataFrame expressions; which side of a join is
broadcast is Spark's choice by the size of stored tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardledger.llm.common import stored, whole_text
from cardledger.llm.licenses import words_of

WINDOW_WORDS = 10
#: How far from the rarest word of a window its other words may stand in a proximity match.
REACH = 12


def positional_index(
    docs: DataFrame, vocabulary: DataFrame | None = None, text_column: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Postings (row, place, term), places from 0; and per document a head with ``n_words`` and the columns ``keep``.

    The head is the posting of place 0, or a posting without place where there is no word; its
    term is null when the vocabulary does not hold it.  ``vocabulary`` (word, term) numbers the
    words that get postings; without it a term is the word itself.
    """
    words = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in keep] or [F.lit(None).cast("int").alias("nothing")]).alias("kept"),
        words_of(whole_text(text_column)).alias("words"),
    )
    placed = words.select(
        "row", "kept", F.size("words").cast("long").alias("n_words"), F.posexplode_outer("words").alias("place", "word")
    )
    head = F.coalesce(F.col("place"), F.lit(0)) == 0
    if vocabulary is None:
        placed = placed.withColumn("term", F.col("word"))
    else:
        placed = placed.join(vocabulary, "word", "left").filter(F.col("term").isNotNull() | head)
    return placed.select(
        "row",
        "place",
        "term",
        head.alias("head"),
        F.when(head, F.col("n_words")).alias("n_words"),
        F.when(head, F.col("kept")).alias("kept"),
    )


def item_windows(items: DataFrame, window_words: int, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item, window): every item's runs of ``window_words`` words, the whole item where it has fewer.  ``window`` is a list of words."""
    words = items.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"), words_of(whole_text(text_column)).alias("words"))
    last = F.greatest(F.size("words") - window_words, F.lit(0))
    starts = F.explode(F.sequence(F.lit(0), last))
    cut = words.filter(F.size("words") > 0).select("item", "words", starts.alias("start"))
    return cut.select("item", F.slice("words", F.col("start") + 1, window_words).alias("window")).distinct()


def _ranked(windows: DataFrame, vocabulary: DataFrame, found: DataFrame) -> DataFrame:
    """(window_id, length, terms): the terms of each window as structs (n, at, term), rarest first; windows that cannot occur are gone."""
    terms = vocabulary.join(found, "term").select("word", "term", "n")
    ranked = (
        windows.select("window_id", F.size("window").alias("length"), F.posexplode("window").alias("at", "word"))
        .join(terms, "word")
        .groupBy("window_id", "length")
        .agg(F.sort_array(F.collect_list(F.struct("n", "at", "term"))).alias("terms"))
    )
    return ranked.filter(F.size("terms") == F.col("length"))


def _probe(ranked: DataFrame, rank: int) -> DataFrame:
    """(window_id, term, at) of the windows' places of one rank, from 0."""
    return ranked.filter(F.size("terms") > rank).select(
        "window_id", F.col("terms")[rank]["term"].alias("term"), F.col("terms")[rank]["at"].alias("at")
    )


def _exact(postings: DataFrame, ranked: DataFrame) -> DataFrame:
    """(row, window_id, start): every occurrence of every window."""
    first = postings.join(_probe(ranked, 0), "term").select("row", "window_id", (F.col("place") - F.col("at")).alias("start"))
    first = stored(first.filter("start >= 0"), "candidates-1")
    second = _probe(ranked, 1)
    lists = postings.join(second.select("term").distinct(), "term", "left_semi")
    asked = first.join(second, "window_id").select("row", "window_id", "start", (F.col("start") + F.col("at")).alias("place"), "term")
    met = asked.join(lists, ["row", "place", "term"], "left_semi").select("row", "window_id", "start")
    # Windows of one word are met by its list alone.
    alone = first.join(ranked.filter("length = 1"), "window_id", "left_semi")
    left = stored(met.unionByName(alone), "candidates-2")
    rows = stored(left.select("row").distinct(), "candidate-rows")
    rest = (
        left.join(ranked, "window_id")
        .select("row", "window_id", "start", "length", F.explode(F.expr("slice(terms, 3, greatest(size(terms) - 2, 0))")).alias("t"))
        .select("row", "window_id", "start", "length", (F.col("start") + F.col("t.at")).alias("place"), F.col("t.term").alias("term"))
    )
    lists = postings.join(rows, "row", "left_semi")
    whole = (
        rest.join(lists, ["row", "place", "term"], "left_semi")
        .groupBy("row", "window_id", "start")
        .agg(F.count(F.lit(1)).alias("met"), F.first("length").alias("length"))
        .filter(F.col("met") == F.col("length") - 2)
        .select("row", "window_id", "start")
    )
    short = left.join(ranked.filter("length <= 2"), "window_id", "left_semi")
    return stored(whole.unionByName(short), "occurrences")


def _near(postings: DataFrame, ranked: DataFrame, reach: int) -> DataFrame:
    """(row, window_id): every term of the window within ``reach`` words of one place of its rarest term."""
    distinct = F.expr("array_distinct(transform(terms, t -> t.term))")  # rarest first, as they were
    ranked = ranked.select("window_id", distinct.alias("terms"))
    probes = ranked.select("window_id", F.col("terms")[0].alias("term"), F.size("terms").alias("wanted"))
    first = postings.join(probes, "term").select("row", "window_id", F.col("place").alias("centre"), "wanted")
    first = stored(first, "near-1")
    # Places fall into blocks as long as the reach to both sides; a reach touches two of them at most.
    width = 2 * reach + 1
    block = lambda place: F.floor(place / F.lit(width)).cast("int")

    def around(candidates: DataFrame) -> DataFrame:
        blocks = F.array_distinct(F.array(block(F.greatest(F.col("centre") - reach, F.lit(0))), block(F.col("centre") + reach)))
        return candidates.withColumn("block", F.explode(blocks))

    def among(lists: DataFrame) -> DataFrame:
        return lists.select("row", "place", "term", block(F.col("place")).alias("block"))

    within = F.abs(F.col("place") - F.col("centre")) <= reach
    second = ranked.filter("size(terms) > 1").select("window_id", F.col("terms")[1].alias("term"))
    lists = among(postings.join(second.select("term").distinct(), "term", "left_semi"))
    asked = around(first.join(second, "window_id"))
    met = asked.join(lists, ["row", "block", "term"]).filter(within).select("row", "window_id", "centre", "wanted").distinct()
    alone = first.filter("wanted = 1").select("row", "window_id", "centre", "wanted")
    left = stored(met.unionByName(alone), "near-2")
    rows = stored(left.select("row").distinct(), "near-rows")
    rest = (
        left.filter("wanted > 2")
        .join(ranked, "window_id")
        .select("row", "window_id", "centre", "wanted", F.explode(F.expr("slice(terms, 3, greatest(size(terms) - 2, 0))")).alias("term"))
    )
    lists = among(postings.join(rows, "row", "left_semi"))
    whole = (
        around(rest)
        .join(lists, ["row", "block", "term"])
        .filter(within)
        .groupBy("row", "window_id", "centre", "wanted")
        .agg(F.count_distinct("term").alias("met"))
        .filter(F.col("met") == F.col("wanted") - 2)
    )
    return whole.select("row", "window_id").unionByName(left.filter("wanted <= 2").select("row", "window_id")).distinct()


def _items_of(matches: DataFrame, items: DataFrame, ids: str, count: str, digest: str | None = None) -> DataFrame:
    """Per row the items of its windows.  Rows with the same windows are looked up once."""
    held = matches.select("row", "window_id").groupBy("row").agg(F.sort_array(F.collect_set("window_id")).alias("windows"))
    held = stored(held.withColumn("name", F.sha2(F.array_join(F.transform("windows", lambda w: w.cast("string")), ","), 256)), f"windows-{ids}")
    once = held.groupBy("name").agg(F.first("windows").alias("windows"))
    listed = (
        once.select("name", F.explode("windows").alias("window_id"))
        .join(items, "window_id")
        .groupBy("name")
        .agg(F.array_sort(F.collect_set("item")).alias(ids))
    )
    values = [F.size(ids).cast("long").alias(count), ids]
    if digest:
        values.append(F.sha2(F.array_join(ids, ","), 256).alias(digest))
    listed = stored(listed.select("name", *values), f"items-{ids}")
    return held.select("row", "name").join(listed, "name").drop("name")


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    keep: tuple[str, ...] | None = None,
    window_words: int = WINDOW_WORDS,
    reach: int | None = REACH,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The columns ``keep`` of every document (all by default) with a struct of what it holds of the items.

    The struct is called ``leak``, with underscores where taken: n_words, n_hit (words inside
    an occurrence of a window), items (ids of the items with one, as text, sorted), n_items,
    items_sha256 (of the ids joined by commas), contaminated, near_items and n_near (the same for
    proximity matches, null where ``reach`` is None).  Null and empty texts have no words; items without words
    have no windows.  Items of one id are one item, a null id is the empty text.  Repeated
    documents and documents without id are each judged.
    """
    keep = tuple(docs.columns) if keep is None else keep
    cut = stored(item_windows(items, window_words, item_column, item_text), "windows")
    windows = cut.select("window").distinct().withColumn("window_id", F.monotonically_increasing_id())
    windows = stored(windows, "window-ids")
    of_items = stored(cut.join(windows, "window").select("window_id", "item").distinct(), "window-items")
    vocabulary = windows.select(F.explode("window").alias("word")).distinct()
    vocabulary = stored(vocabulary.withColumn("term", F.monotonically_increasing_id()), "vocabulary")
    index = stored(positional_index(docs, vocabulary, text_column, keep), "postings")
    postings = index.filter("term IS NOT NULL").select("row", "place", "term")
    found = stored(postings.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term-counts")
    ranked = stored(_ranked(windows, vocabulary, found), "ranked-windows")

    occurrences = _exact(postings, ranked)
    ends = occurrences.join(ranked.select("window_id", "length"), "window_id").select(
        "row", F.col("start").cast("long").alias("start"), (F.col("start") + F.col("length")).cast("long").alias("end")
    )
    ends = ends.groupBy("row", "start").agg(F.max("end").alias("end"))
    before = F.coalesce(
        F.max("end").over(Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    hits = (
        ends.withColumn("fresh", F.greatest(F.col("end") - F.greatest("start", before), F.lit(0)))
        .groupBy("row")
        .agg(F.sum("fresh").alias("n_hit"))
    )
    exact = _items_of(occurrences.select("row", "window_id").distinct(), of_items, "items", "n_items", "items_sha256")
    heads = index.filter("head").select("row", "n_words", "kept")
    joined = heads.join(hits, "row", "left").join(exact, "row", "left")
    if reach is not None:
        joined = joined.join(_items_of(_near(postings, ranked, reach), of_items, "near_items", "n_near"), "row", "left")
    else:
        joined = joined.withColumns({"near_items": F.lit(None).cast("array<string>"), "n_near": F.lit(None).cast("long")})
    zero, none = F.lit(0).cast("long"), F.array().cast("array<string>")
    name = "leak"
    while name in {c.lower() for c in keep}:
        name += "_"
    leak = F.struct(
        "n_words",
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        F.coalesce("items", none).alias("items"),
        (F.coalesce("n_near", zero) if reach is not None else F.col("n_near")).alias("n_near"),
        (F.coalesce("near_items", none) if reach is not None else F.col("near_items")).alias("near_items"),
    )
    return joined.select(*[F.col(f"kept.`{c}`").alias(c) for c in keep], leak.alias(name))

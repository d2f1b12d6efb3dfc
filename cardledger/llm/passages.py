"""Repeated passages by sparse suffix arrays.

Only suffixes at content-selected places are kept: where a hash of ``SEED_WORDS`` words is
the smallest of all that a passage of ``min_words`` can hold around it.  Two texts that
share a passage of that length have selected a place of it alike, whatever stands around.
Suffixes whose seed occurs in one document only are dropped; the others get the words
after and before the seed, as hashes.  They are sorted once by what follows and once by
what precedes, over all partitions, neighbours from different documents are compared (however
many places of one document stand between them), and each match is extended to both sides.  What adds up to ``min_words`` or more is a span;
overlapping spans of a document become one passage.

The nearest neighbours also bound what any other document can share: nobody follows a
suffix further than its neighbour in the one order, nobody precedes it further than its
neighbour in the other.  Where the spans found stay below these bounds, a match may stand
between other documents' longer one-sided ones.  Each window of ``min_words`` words within
the bounds is then looked up by its hash among all suffixes of that seed, so nothing is lost.

The sort deals suffixes by seed, context and row, so a passage that a third of all
documents share is cut over as many partitions as its rows need; the few suffixes at the
ends of partitions, with the first and the last document's whole run there, are compared
once more together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardledger.llm.common import stored, text_batches
from cardledger.llm.shingles import shingle_hashes, word_hashes

_U = np.uint64
MIN_WORDS = 50
SEED_WORDS = 20
#: Following suffixes that one is compared with, besides the nearest ones of other rows.
REACH = 4

_SUFFIX = "seed bigint, row bigint, at int, right binary, left binary"
_MATCH = "seed bigint, row bigint, at int, before int, after int, left int, right int, other bigint"
_MATCH_COLUMNS = [column.split()[0] for column in _MATCH.split(", ")]
#: Above every row number.
_NOBODY = 2**63 - 1


def _sliding(values: np.ndarray, width: int, better) -> np.ndarray:
    """The best of ``width`` values from each place on, by doubling."""
    done, found = 1, values
    while done < width:
        step = min(done, width - done)
        found = better(found[: len(found) - step], found[step:])
        done += step
    return found


def selected_places(words: np.ndarray, first: np.ndarray, seed_words: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(word number, seed) where a seed is the smallest of a stretch of ``min_words`` words."""
    window = min_words - seed_words + 1
    counts = np.diff(first)
    if len(words) < min_words:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=_U)
    seeds, _ = shingle_hashes(words, np.array([0, len(words)]), seed_words)
    least = _sliding(seeds, window, np.minimum)
    # Stretches that reach into the next text select nothing.
    start = np.arange(len(least))
    end_of_text = np.repeat(first[1:], counts)[: len(least)]
    least = np.where(start + min_words <= end_of_text, least, _U(0))
    padded = np.concatenate([np.zeros(window - 1, dtype=_U), least, np.zeros(window - 1, dtype=_U)])
    most = _sliding(padded, window, np.maximum)[: len(seeds)]
    at = np.flatnonzero((most == seeds) & (seeds > 0))
    values = seeds[at]
    # Of a run of equal seeds (one word over and over) the two ends, and between them places whose contexts meet.
    inner = np.zeros(len(at), dtype=bool)
    if len(at) > 2:
        steady = (np.diff(at) == 1) & (values[1:] == values[:-1])
        inner[1:-1] = steady[:-1] & steady[1:]
        begins = np.maximum.accumulate(np.where(np.concatenate([[False], steady]), 0, np.arange(len(at))))
        inner &= (np.arange(len(at)) - begins) % max(1, min_words - seed_words) != 0
    return at[~inner], values[~inner]


def _anchors(docs: DataFrame, seed_words: int, min_words: int) -> DataFrame:
    """(seed, row, at) of the selected places of (row, text)."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for start, texts in text_batches(batch.column(1)):
                words, first = word_hashes(texts)
                at, seeds = selected_places(words, first, seed_words, min_words)
                text = np.searchsorted(first, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(seeds.view(np.int64)),
                        pa.array(rows[start + text]),
                        pa.array((at - first[text]).astype(np.int32)),
                    ],
                    names=["seed", "row", "at"],
                )

    return docs.mapInArrow(select, "seed bigint, row bigint, at int")


def _suffixes(docs: DataFrame, seed_words: int, min_words: int) -> DataFrame:
    """The suffixes of (row, text, places): words after and before each seed, four bytes each."""
    reach = min_words - seed_words

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_batches(batch.column(1)):
                words, first = word_hashes(texts)
                coded = (words >> _U(32)).astype(">u4").tobytes()
                back = (words[::-1] >> _U(32)).astype(">u4").tobytes()
                part = batch.slice(start, len(texts))
                places = part.column(2)
                flat = places.flatten()
                at = flat.field("at").to_numpy()
                text = np.repeat(np.arange(len(texts)), places.value_lengths().to_numpy())
                here, begin, end = at + first[text], first[text], first[text + 1]
                after = here + seed_words
                right = [coded[4 * a : 4 * b] for a, b in zip(after.tolist(), np.minimum(after + reach, end).tolist(), strict=True)]
                total = len(words)
                left = [
                    back[4 * (total - b) : 4 * (total - a)]
                    for a, b in zip(np.maximum(here - reach, begin).tolist(), here.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        flat.field("seed"),
                        part.column(0).take(pa.array(text)),
                        flat.field("at"),
                        pa.array(right, pa.binary()),
                        pa.array(left, pa.binary()),
                    ],
                    names=["seed", "row", "at", "right", "left"],
                )

    return docs.mapInArrow(extend, _SUFFIX)


def _codes(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(word codes, number of words) of binary contexts, as a table of ``width`` columns."""
    texts = column.to_pylist()
    table = np.frombuffer(b"".join(t.ljust(4 * width, b"\0") for t in texts), dtype=np.uint32)
    return table.reshape(len(texts), width), np.array([len(t) // 4 for t in texts], dtype=np.int64)


def _run_starts(seeds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where runs of one row's places begin in a sorted batch."""
    return np.concatenate([[0], 1 + np.flatnonzero((rows[1:] != rows[:-1]) | (seeds[1:] != seeds[:-1]))])


def _starts_of(batch: pa.RecordBatch) -> np.ndarray:
    return _run_starts(batch.column(0).to_numpy(), batch.column(1).to_numpy())


def _tail(batch: pa.RecordBatch) -> pa.RecordBatch:
    """What later rows are compared with: the last run, at most one document's places, and the row before it."""
    return batch.slice(max(0, min(batch.num_rows - REACH, int(_starts_of(batch)[-1]) - 1)))


def _common(table: np.ndarray, sizes: np.ndarray, a: slice | np.ndarray, b: slice | np.ndarray) -> np.ndarray:
    same = table[a] == table[b]
    length = np.where(same.all(axis=1), table.shape[1], np.argmin(same, axis=1))
    return np.minimum(length, np.minimum(sizes[a], sizes[b]))


def _compared(batch: pa.RecordBatch, fresh: int, seed_words: int, min_words: int) -> pa.RecordBatch:
    """What the places of a sorted batch share with neighbours, at least one of the two from ``fresh`` on.

    ``before`` and ``after`` are the most words shared on either side of the seed with any
    neighbour, ``left`` and ``right`` those of neighbours that share ``min_words`` in all (-1: none).
    """
    reach = min_words - seed_words
    seeds, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    right, right_size = _codes(batch.column(3), reach)
    left, left_size = _codes(batch.column(4), reach)
    n = len(seeds)
    pairs = []
    for step in range(1, REACH + 1):
        begin = max(fresh - step, 0)
        if n - step > begin:
            pairs.append((slice(begin, n - step), slice(begin + step, n)))
    # Inside a longer run of one row: the last place before the run and the first one after it.
    starts = _run_starts(seeds, rows)
    sizes = np.diff(np.concatenate([starts, [n]]))
    every, before_run = np.arange(n), np.repeat(starts - 1, sizes)
    after_run = np.repeat(starts + sizes, sizes)
    far = (after_run < n) & (after_run >= fresh) & (after_run - every > REACH)
    beside = [(every[far], after_run[far])]
    far = (before_run >= 0) & (every >= fresh) & (every - before_run > REACH)
    beside.append((every[far], before_run[far]))
    most = np.zeros((2, n), dtype=np.int32)
    valid = np.full((2, n), -1, dtype=np.int32)
    other = np.full(n, _NOBODY, dtype=np.int64)
    for number, (a, b) in enumerate([*pairs, *beside]):
        shared = np.stack([_common(left, left_size, a, b), _common(right, right_size, a, b)])
        apart = (seeds[a] == seeds[b]) & (rows[a] != rows[b])
        good = apart & (shared.sum(axis=0) >= reach)
        # The row beside a run has a nearest neighbour of its own; only the run's place gains.
        for x, y in ((a, b), (b, a))[: 2 if number < len(pairs) else 1]:
            most[:, x] = np.maximum(most[:, x], np.where(apart, shared, 0))
            valid[:, x] = np.maximum(valid[:, x], np.where(good, shared, -1))
            other[x] = np.where(good, np.minimum(other[x], rows[y]), other[x])
    some = np.flatnonzero((most.sum(axis=0) > 0) | (valid[0] >= 0))
    columns = [batch.column(i).take(pa.array(some)) for i in range(3)]
    columns += [pa.array(c[some]) for c in (*most, *valid, other)]
    return pa.RecordBatch.from_arrays(columns, names=_MATCH_COLUMNS)


def _neighbours(suffixes: DataFrame, context: str, seed_words: int, min_words: int) -> DataFrame:
    """What neighbours in the order of seed, ``context`` and row share; a place may have several rows."""
    order = ["seed", context, "row", "at"]
    names = ["seed", "row", "at", "right", "left"]
    ends_kind = f"struct<{_SUFFIX}>".replace(" ", ":").replace(",:", ",")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, opening, opened = None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            if not opened:
                # The first run and the row after it.
                opening = batch if opening is None else pa.concat_batches([opening, batch])
                starts = _starts_of(opening)
                if len(starts) > 1 and opening.num_rows >= REACH:
                    opening, opened = opening.slice(0, max(REACH, int(starts[1]) + 1)), True
            whole = batch if held is None else pa.concat_batches([held, batch])
            yield from _matches(_compared(whole, 0 if held is None else held.num_rows, seed_words, min_words))
            held = _tail(whole)
        if held is not None:
            for rows in (opening, held):
                yield _ends(rows)

    def _matches(found: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if found.num_rows:
            empty = pa.nulls(found.num_rows, kind)
            yield pa.RecordBatch.from_arrays([*found.columns, empty], names=[*_MATCH_COLUMNS, "end"])

    def _ends(rows: pa.RecordBatch) -> pa.RecordBatch:
        long, short = pa.nulls(rows.num_rows, pa.int64()), pa.nulls(rows.num_rows, pa.int32())
        end = pa.StructArray.from_arrays(rows.columns, names=names)
        empty = [long, long, *[short] * 5, long]
        return pa.RecordBatch.from_arrays([*empty, end], names=[*_MATCH_COLUMNS, "end"])

    kind = pa.struct(
        [("seed", pa.int64()), ("row", pa.int64()), ("at", pa.int32()), ("right", pa.binary()), ("left", pa.binary())]
    )
    partitions = int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = suffixes.select(*names).repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    found = stored(ordered.mapInArrow(compare, f"{_MATCH}, end {ends_kind}"), f"matches-{context}")

    def compare_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            whole = batch if held is None else pa.concat_batches([held, batch])
            yield _compared(whole, 0 if held is None else held.num_rows, seed_words, min_words)
            held = _tail(whole)

    # Some 2 x REACH rows of each partition, more where a long run of one row stands at its end; distinct, as a small partition's ends overlap.
    ends = found.filter("end IS NOT NULL").select("end.*").distinct().coalesce(1).sortWithinPartitions(*order)
    across = ends.select(*names).mapInArrow(compare_ends, _MATCH)
    return found.filter("end IS NULL").drop("end").unionByName(across)


def _windows(suffixes: DataFrame, reach: int, places: Column) -> DataFrame:
    """``suffixes`` once for each of ``places`` (words of a window before the seed), with the window's hash."""
    whole = suffixes.withColumn("words_before", F.explode(places))
    before = F.substring("left", F.lit(1), 4 * F.col("words_before"))
    after = F.substring("right", F.lit(1), 4 * (reach - F.col("words_before")))
    return whole.withColumn("window", F.xxhash64(before, after))


def _between(matches: DataFrame, suffixes: DataFrame, reach: int) -> DataFrame:
    """(row, at, left, right, other) of matches that stand between other rows' longer one-sided ones.

    Asks for the windows that the bounds allow and no span covers; only seeds in question are
    looked through, and equal surroundings of a seed stand once.
    """
    low, high = F.greatest(reach - F.col("after"), F.lit(0)), F.col("before")
    open_ones = matches.filter("before > left OR after > right").filter(low <= high)
    bounds = open_ones.select("seed", "row", "at", low.alias("low"), high.alias("high"), F.col("left").alias("l"), F.col("right").alias("r"))
    bounds = stored(bounds, "open-bounds")
    asked = _windows(
        bounds.join(suffixes, ["seed", "row", "at"]),
        reach,
        F.filter(F.sequence("low", "high"), lambda j: (j > F.col("l")) | (reach - j > F.col("r"))),
    )
    # A table of its own, so that the adaptive skew join can cut a seed that many rows have.
    seeds = stored(bounds.groupBy("seed").agg(F.min("low").alias("low"), F.max("high").alias("high")), "open-seeds")
    kinds = (
        suffixes.join(seeds, "seed")
        .groupBy("seed", "left", "right", "low", "high")
        .agg(F.min("row").alias("first_row"), F.max("row").alias("last_row"))
        .withColumn("low", F.greatest("low", reach - (F.length("right") / 4).cast("int")))
        .withColumn("high", F.least("high", (F.length("left") / 4).cast("int")))
        .filter("low <= high")
    )
    key = ["seed", "words_before", "window"]
    held = _windows(kinds, reach, F.sequence("low", "high")).groupBy(*key)
    held = held.agg(F.min("first_row").alias("first_row"), F.max("last_row").alias("last_row")).filter("first_row < last_row")
    return asked.select(*key, "row", "at").join(stored(held, "open-windows"), key).select(
        "row",
        "at",
        F.col("words_before").alias("left"),
        (reach - F.col("words_before")).alias("right"),
        F.when(F.col("first_row") == F.col("row"), F.col("last_row")).otherwise(F.col("first_row")).alias("other"),
    )


def repeated_passages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_words: int = MIN_WORDS,
    seed_words: int = SEED_WORDS,
) -> DataFrame:
    """One row per passage: doc_id, first_word, end_word, words, partner_id, row.

    A passage is a stretch of words (numbered from 0, ``end_word`` excluded) of which every
    part lies in a run of at least ``min_words`` words that stands in another row's text
    too; ``partner_id`` is the smallest id among the rows it was matched with.  Words are
    compared by case-folded hashes.  Shorter, empty and null texts have none; repeated rows
    match each other; rows without id are searched like all others.
    """
    numbered = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_column).alias("doc_id"),
            F.col(text_column).cast("string").alias("text"),
        ),
        "numbered-texts",
    )
    anchors = stored(_anchors(numbered.select("row", "text"), seed_words, min_words), "anchors")
    repeated = anchors.groupBy("seed").agg(F.min("row").alias("low"), F.max("row").alias("high"))
    # A table of its own, so that the adaptive skew join can cut a seed that many rows have.
    repeated = stored(repeated.filter("low <> high").select("seed"), "repeated-seeds")
    places = (
        anchors.join(repeated, "seed", "left_semi")
        .groupBy("row")
        .agg(F.collect_list(F.struct("seed", "at")).alias("places"))  # a row's own places
    )
    suffixes = stored(
        _suffixes(numbered.select("row", "text").join(places, "row").select("row", "text", "places"), seed_words, min_words),
        "suffixes",
    )
    matches = _neighbours(suffixes, "right", seed_words, min_words).unionByName(
        _neighbours(suffixes, "left", seed_words, min_words)
    )
    matches = matches.groupBy("seed", "row", "at").agg(
        *[F.max(c).alias(c) for c in ("before", "after", "left", "right")], F.min("other").alias("other")
    )
    matches = stored(matches, "matches")
    shared = matches.filter("left >= 0").select("row", "at", "left", "right", "other")
    shared = shared.unionByName(_between(matches, suffixes, min_words - seed_words))
    ids = numbered.select("row", "doc_id")
    partners = ids.select(F.col("row").alias("other"), F.col("doc_id").alias("partner_id"))
    spans = shared.select(
        "row",
        (F.col("at") - F.col("left")).cast("bigint").alias("first_word"),
        (F.col("at") + seed_words + F.col("right")).cast("bigint").alias("end_word"),
        "other",
    ).join(partners, "other")
    # A row's own spans: one begins a passage where all before it have ended.
    one = Window.partitionBy("row").orderBy("first_word", "end_word")
    reached = F.max("end_word").over(one.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached >= F.col("first_word"), 0).otherwise(1)
    passage = F.sum("begins").over(one.rowsBetween(Window.unboundedPreceding, 0))
    merged = (
        spans.withColumn("begins", begins)
        .withColumn("passage", passage)
        .groupBy("row", "passage")
        .agg(F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word"), F.min("partner_id").alias("partner_id"))
    )
    return merged.join(ids, "row").select(
        "doc_id", "first_word", "end_word", (F.col("end_word") - F.col("first_word")).alias("words"), "partner_id", "row"
    )

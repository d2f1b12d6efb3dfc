"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

A document longer than a sequence is cut into whole sequences and one shorter first
piece; every shorter document is one piece.  Whole sequences need no packing.  The short
pieces are dealt into shards of bounded size, and each shard is packed by several islands.
An island keeps a few packings; a child takes the well-filled bins of one parent whole,
keeps the bins of the other that share no piece with them, and the displaced pieces are
put back by best fit, longest first.  Between epochs each island's best packing moves to
the next island.  An island stops when it has reached the lower bound, the total length
over the capacity.  The best packing of a shard's islands is the result.

Only lengths take part: a shard is a few thousand numbers whatever the texts are.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from importlib.util import find_spec

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.llm.common import stored

CAPACITY = 1024
END_TOKEN = 2
#: Pieces that one shard holds on average; what an island has in memory.
SHARD_PIECES = 8192
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 4
POPULATION = 4
#: Bits for the documents, and for the whole sequences, of one input partition; 23 are left for the partition.
ROW_BITS = 40

#: Fixed value: the special token of the public vocabulary; its id follows the ranks.
SPECIAL = "<|endoftext|>"


def byte_encoder(path: str):
    """The byte-level BPE of a rank file with its special token, kept by the library between tasks."""
    import public_tokenizers
    import tiktoken
    from tiktoken import registry

    if path not in registry.ENCODINGS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        registry.ENCODINGS[path] = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)}
        )
    return registry.ENCODINGS[path]


def default_vocabulary() -> str:
    """The public 50k byte-level BPE as ranks: the same ids as its tokenizers file, read faster."""
    if find_spec("public_tokenizers") is None:
        raise ImportError("public_tokenizers is not installed; give the path of a rank file")
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def tokenised(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """(row, whole, doc_id, tokens, crcs, ids) per document: its token count and the crc32 of every piece.

    ``row`` numbers documents, ``whole`` the whole sequences that are cut from them: it is the
    document's first one's, each further one has the next number.

    Ids end with ``END_TOKEN``, so an empty or null text is one token.  As in the vocabulary's
    tokenizers file, a string that spells the special token is that token.  ``ids`` is null
    unless asked for.
    """
    path = vocabulary or default_vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        partition, row, whole = TaskContext.get().partitionId(), 0, 0
        if partition >> (63 - ROW_BITS):
            raise ValueError("more partitions than row numbers have room for")
        for batch in batches:
            rows, wholes, tokens, crcs, kept = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = np.array([*encoder.encode(text or "", allowed_special={SPECIAL}), END_TOKEN], dtype="<u4")
                rows.append(partition << ROW_BITS | row)
                wholes.append(partition << ROW_BITS | whole)
                row += 1
                whole += len(ids) // capacity
                tokens.append(len(ids))
                head = len(ids) % capacity
                cuts = [0, *range(head or capacity, len(ids) + 1, capacity)]
                crcs.append([zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])
                kept.append(ids.astype(np.int32) if with_ids else None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows, pa.int64()),
                    pa.array(wholes, pa.int64()),
                    batch.column(0),
                    pa.array(tokens, pa.int64()),
                    pa.array(crcs, pa.list_(pa.int64())),
                    pa.array(kept, pa.list_(pa.int32())),
                ],
                names=["row", "whole", "doc_id", "tokens", "crcs", "ids"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(
        encode, f"row bigint, whole bigint, doc_id {kind}, tokens bigint, crcs array<bigint>, ids array<int>"
    )


class Bins:
    """Room of open bins, and the bin with the least room that still takes a piece."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0  # bit r is set if a bin has room r

    def add(self, number: int, room: int) -> None:
        self.with_room[room].append(number)
        self.rooms |= 1 << room

    def take(self, length: int) -> tuple[int, int] | None:
        """(bin, room left) of the best fit, or None."""
        fitting = self.rooms >> length
        if not fitting:
            return None
        room = length + (fitting & -fitting).bit_length() - 1
        number = self.with_room[room].pop()
        if not self.with_room[room]:
            self.rooms &= ~(1 << room)
        self.add(number, room - length)
        return number, room - length


def best_fit(lengths: list[int], order: list[int], capacity: int, placed: np.ndarray) -> np.ndarray:
    """Bins of all pieces: ``placed`` where that is set, the others by best fit in ``order``."""
    found = placed.tolist()
    bins = Bins(capacity)
    next_bin = 0
    if (placed >= 0).any():
        used = np.bincount(placed[placed >= 0], weights=np.asarray(lengths)[placed >= 0]).astype(int).tolist()
        next_bin = len(used)
        for number, full in enumerate(used):
            bins.add(number, capacity - full)
    for piece in order:
        if found[piece] < 0:
            fit = bins.take(lengths[piece])
            if fit is None:
                bins.add(next_bin, capacity - lengths[piece])
                found[piece] = next_bin
                next_bin += 1
            else:
                found[piece] = fit[0]
    return np.array(found, dtype=np.int64)


def fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins are better, then fuller ones: (bins, - sum of squared fillings)."""
    fill = np.bincount(bins, weights=lengths) / capacity
    return int((fill > 0).sum()), -float((fill**2).sum())


def crossover(
    lengths: np.ndarray, giver: np.ndarray, taker: np.ndarray, order: list[int], capacity: int, chance: np.random.Generator
) -> np.ndarray:
    """A child: well-filled bins of ``giver``, untouched bins of ``taker``, the rest by best fit."""
    fill = np.bincount(giver, weights=lengths)
    good = np.flatnonzero(fill >= np.quantile(fill[fill > 0], 0.5))
    injected = np.zeros(len(fill), dtype=bool)
    injected[chance.permutation(good)[: max(1, len(good) // 2)]] = True
    inside = injected[giver]
    broken = np.zeros(taker.max() + 1, dtype=bool)
    broken[taker[inside]] = True
    stays = ~inside & ~broken[taker]
    labels = np.full(len(lengths), -1, dtype=np.int64)
    labels[inside] = giver[inside]
    labels[stays] = taker[stays] + len(fill)
    used, compact = np.unique(labels[labels >= 0], return_inverse=True)
    labels[labels >= 0] = compact
    return best_fit(lengths.tolist(), order, capacity, labels)


def evolve(
    lengths: np.ndarray, packings: list[np.ndarray], seed: int, capacity: int = CAPACITY, generations: int = GENERATIONS
) -> list[np.ndarray]:
    """An island's packings after some generations, best first; ``lengths`` descend."""
    chance = np.random.default_rng(seed)
    order = list(range(len(lengths)))
    bound = -(-int(lengths.sum()) // capacity)
    empty = np.full(len(lengths), -1, dtype=np.int64)
    rank = lambda p: fitness(lengths, p, capacity)
    if not packings:
        packings = [best_fit(lengths.tolist(), order, capacity, empty)]
    packings.sort(key=rank)
    while len(packings) < POPULATION and rank(packings[0])[0] > bound:
        loose = np.argsort(-(lengths * chance.uniform(0.8, 1.2, len(lengths))), kind="stable").tolist()
        packings.append(best_fit(lengths.tolist(), loose, capacity, empty))
    for _ in range(generations):
        packings.sort(key=rank)
        if rank(packings[0])[0] <= bound:
            break
        children = []
        for i in range(len(packings) - 1):
            other = packings[int(chance.integers(len(packings)))]
            children.append(crossover(lengths, other, packings[i], order, capacity, chance))
        packings = sorted([*packings, *children], key=rank)[:POPULATION]
    return sorted(packings, key=rank)[:POPULATION]


_PACKINGS = "shard bigint, island int, bins array<int>"


def pack_lengths(
    pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, islands: int = ISLANDS, epochs: int = EPOCHS
) -> DataFrame:
    """(row, bin, offset) for pieces (row, length) of 1 to ``capacity``: bin is unique over all shards."""
    shards = max(1, round(pieces.count() / shard_pieces))
    dealt = pieces.select("row", "length", F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"))
    on_islands = dealt.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))

    def ordered(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        part = part.sort_values(["length", "row"], ascending=[False, True])
        return part["row"].to_numpy(), part["length"].to_numpy()

    def epoch(key, part: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        _, lengths = ordered(part)
        start = [np.asarray(b, dtype=np.int64) for b in before["bins"]]
        found = evolve(lengths, start, hash_seed(int(key[0]), int(key[1]), len(start)), capacity)
        return pd.DataFrame({"shard": key[0], "island": key[1], "bins": [p.astype(np.int32) for p in found]})

    packings = pieces.sparkSession.createDataFrame([], _PACKINGS)
    for step in range(epochs):
        found = on_islands.groupBy("shard", "island").cogroup(packings.groupBy("shard", "island")).applyInPandas(epoch, _PACKINGS)
        found = stored(found, f"packings-{step}")
        # Elites move on: an island's first packing also starts on the next island.
        elite = found.groupBy("shard", "island").agg(F.min_by("bins", F.array_max("bins")).alias("bins"))
        moved = elite.withColumn("island", ((F.col("island") + 1) % islands).cast("int"))
        packings = found.unionByName(moved) if islands > 1 else found

    def place(key, part: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        rows, lengths = ordered(part)
        choices = [np.asarray(b, dtype=np.int64) for b in before["bins"]]
        bins = min(choices, key=lambda p: fitness(lengths, p, capacity))
        by_bin = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[by_bin])
        begins = ends - lengths[by_bin]
        first = np.searchsorted(bins[by_bin], bins[by_bin])
        offsets = np.empty(len(rows), dtype=np.int64)
        offsets[by_bin] = begins - begins[first]
        return pd.DataFrame({"row": rows, "bin": (int(key[0]) << 24) + bins, "offset": offsets})

    return dealt.groupBy("shard").cogroup(found.groupBy("shard")).applyInPandas(
        place, "row bigint, bin bigint, offset bigint"
    )


def hash_seed(*numbers: int) -> int:
    return zlib.crc32(repr(numbers).encode())


def pack_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    shard_pieces: int = SHARD_PIECES,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if asked for.

    Repeated rows are packed as often as they occur.  An empty table has no pieces.
    """
    tokens = stored(tokenised(docs, id_column, text_column, capacity, vocabulary, with_ids), "tokens")
    head = F.pmod(F.col("tokens"), F.lit(capacity))
    short = tokens.select("row", head.alias("length")).filter("length > 0")
    placed = stored(pack_lengths(short, capacity, shard_pieces, islands, epochs), "places")
    pieces = (
        tokens.join(placed, "row", "left")
        .select("*", head.alias("head"), F.posexplode("crcs").alias("piece", "ids_crc32"))
        .withColumn("first", (F.col("piece") == 0) & (F.col("head") > 0))
        .withColumn("length", F.when(F.col("first"), F.col("head")).otherwise(F.lit(capacity)))
        .withColumn(
            "start",
            F.when(F.col("first"), F.lit(0)).otherwise(
                F.col("head") + (F.col("piece") - (F.col("head") > 0).cast("int")) * capacity
            ),
        )
    )
    alone = -1 - (F.col("whole") + F.col("piece") - (F.col("head") > 0).cast("int"))
    columns = [
        "doc_id",
        F.col("piece").cast("int").alias("piece"),
        F.col("start").cast("long").alias("start"),
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        F.when(F.col("first"), F.col("bin")).otherwise(alone).alias("sequence_id"),
        F.when(F.col("first"), F.col("offset")).otherwise(F.lit(0)).cast("long").alias("offset"),
    ]
    if with_ids:
        columns.append(F.expr("slice(ids, int(start) + 1, int(length))").alias("ids"))
    return pieces.select(*columns)

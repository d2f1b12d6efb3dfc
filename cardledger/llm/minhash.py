"""Near-duplicates by DartMinHash signatures, banded joins and exact verification.

A text is a weighted set of shingles.  Darts are thrown at each element's weight: a
Poisson process over weight and rank, seeded by the element, so that an element has the
same darts in every set and a set keeps those within its weights.  Each dart belongs to
one of k coordinates; the earliest dart of a coordinate is its signature.  Two sets agree
in a coordinate with the probability of their weighted Jaccard similarity.  Only darts
up to a rank that leaves about k log k + 2k of them are looked at, so a set costs its
size plus that, not k times its size.

Candidates share a band of coordinates.  A bucket is not expanded into pairs: its members
are compared with its most central one (a star), and the similar ones become one component.
A member that stays apart from the centre can still be similar to another member.  So the
members of a centre's buckets are kept as differences from their common set, what most of
them have.  The size of what two differences share says how similar two members are.  The
member nearest to the common set is compared with all others; of the members of different
components that are still apart only those are compared that share a shingle among the
first, rarest ones of both differences, no more of them than the similarity asks for.
No similar pair of a bucket is lost, and a group of thousands of copies with edits of
their own costs a few comparisons each.  Similarity is exact, on whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardledger.llm.common import connected_components, free_name, stored, text_batches
from cardledger.llm.shingles import mixed, shingle_hashes, sorted_sets, word_hashes

_U = np.uint64
WIDTH = 5
SIMILARITY = 0.8
#: 20 bands of 4: two sets of similarity 0.8 share a band with probability 0.99997.
BANDS = 20
ROWS = 4


def dart_signatures(
    elements: np.ndarray, weights: np.ndarray, first: np.ndarray, coordinates: int
) -> np.ndarray:
    """One signature of ``coordinates`` 64-bit values for every set; an empty set has zeros.

    ``elements`` and positive ``weights`` of set i stand from first[i] to first[i + 1].
    """
    n = len(first) - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    # A weight above 1 is cut into unit cells, each with its own process; the last may be partial.
    cells = np.maximum(np.ceil(weights).astype(np.int64), 1)
    cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
    seed = mixed(np.repeat(elements, cells) + cell.astype(_U) * _U(0xA24BAED4963EE407))
    room = np.repeat(weights, cells) - cell
    owner = np.repeat(owner, cells)
    total = np.bincount(owner, weights=np.minimum(room, 1.0), minlength=n).astype(np.float64)
    signature = np.zeros(n * coordinates, dtype=_U)
    darts = coordinates * (np.log(coordinates) + 2)
    reach = np.divide(darts, total, out=np.zeros(n), where=total > 0)
    waiting = total > 0
    while waiting.any():
        use = waiting[owner]
        slots, ranks, names = _throw(seed[use], room[use], owner[use], reach, coordinates)
        order = np.argsort(ranks)[::-1]  # the earliest dart of a slot is written last
        hit = np.zeros(n * coordinates, dtype=bool)
        hit[slots] = True
        signature[slots[order]] = names[order]
        waiting &= ~hit.reshape(n, coordinates).all(axis=1)
        reach = reach * 2
    return signature.reshape(n, coordinates)


def _throw(seed, room, owner, reach, coordinates):
    """(slot, rank, name) of all darts up to each set's reach."""
    slots, ranks, names = [], [], []
    rank = np.zeros(len(seed))
    limit = reach[owner]
    step = 0
    while len(seed):
        step += 1
        draw = mixed(seed + _U(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        rank = rank - np.log(((draw >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53)
        live = rank <= limit
        seed, room, owner, limit, rank, draw = (x[live] for x in (seed, room, owner, limit, rank, draw))
        name = mixed(draw ^ _U(0x5851F42D4C957F2D))
        place = (mixed(name) >> _U(11)).astype(np.float64) * 2.0**-53
        inside = place < room  # the dart's height within its cell
        slots.append((owner * coordinates + (name % _U(coordinates)).astype(np.int64))[inside])
        ranks.append(rank[inside])
        names.append(name[inside])
    return np.concatenate(slots), np.concatenate(ranks), np.concatenate(names)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=_U)), (len(signatures), bands)).copy()
    parts = signatures.reshape(len(signatures), bands, rows)
    for i in range(rows):
        keys = mixed(keys * _U(0xD6E8FEB86659FD93) + parts[:, :, i])
    return keys


def sketches(docs: DataFrame, width: int, bands: int, rows: int, weighted: bool) -> DataFrame:
    """(row, doc_id, size, print_a, print_b, keys) of every row of (row, doc_id, text)."""
    schema = "row bigint, doc_id {}, size double, print_a bigint, print_b bigint, keys array<bigint>"
    schema = schema.format(docs.schema["doc_id"].dataType.simpleString())

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_batches(batch.column(2)):
                values, counts, first = sorted_sets(*shingle_hashes(*word_hashes(texts), width))
                weights = counts.astype(np.float64) if weighted else np.ones(len(values))
                keys = band_keys(dart_signatures(values, weights, first, bands * rows), bands, rows)
                owner = np.repeat(np.arange(len(texts)), np.diff(first))
                named = mixed(values + weights.astype(_U))
                prints = []
                for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
                    total = np.zeros(len(texts), dtype=_U)
                    np.add.at(total, owner, mixed(named ^ _U(salt)))
                    prints.append(total.view(np.int64))
                size = np.bincount(owner, weights=weights, minlength=len(texts)).astype(np.float64)
                some = size > 0
                offsets = np.concatenate([[0], np.cumsum(np.where(some, bands, 0))]).astype(np.int32)
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(size),
                        pa.array(prints[0]),
                        pa.array(prints[1]),
                        pa.ListArray.from_arrays(offsets, pa.array(keys[some].reshape(-1).view(np.int64))),
                    ],
                    names=["row", "doc_id", "size", "print_a", "print_b", "keys"],
                )

    return docs.mapInArrow(sketch, schema)


def shingle_sets(docs: DataFrame, width: int, weighted: bool) -> DataFrame:
    """(node, members): the set of each (node, text) as 32-bit values, for exact comparison.

    A member is a hash of the shingle and, in the weighted case, the number of its
    occurrence, so that the Jaccard similarity of these sets is the weighted one.  Members
    stand in the order of their values as unsigned numbers.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_batches(batch.column(1)):
                values, counts, first = sorted_sets(*shingle_hashes(*word_hashes(texts), width))
                if weighted:
                    occurrence = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    first = np.concatenate([[0], np.cumsum(counts)])[first]
                    values, _, first = sorted_sets(mixed(np.repeat(values, counts) + occurrence.astype(_U)), first)
                members = (values >> _U(32)).astype(np.uint32)
                fresh = np.ones(len(members), dtype=bool)
                fresh[1:] = members[1:] != members[:-1]
                fresh[first[:-1][first[:-1] < len(members)]] = True
                first = np.concatenate([[0], np.cumsum(fresh)])[first]
                members = members[fresh].view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.slice(at, len(texts)).column(0),
                        pa.ListArray.from_arrays(first.astype(np.int32), pa.array(members)),
                    ],
                    names=["node", "members"],
                )

    return docs.mapInArrow(sets, "node bigint, members array<int>")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: float = SIMILARITY,
    width: int = WIDTH,
    bands: int = BANDS,
    rows: int = ROWS,
    weighted: bool = False,
    row_column: str | None = None,
) -> DataFrame:
    """One row per document: row, doc_id, class_id, class_size, kept, copies, links.

    A class is a connected component of documents whose shingle sets (``weighted``: with
    counts) have a Jaccard similarity of ``similarity`` or more.  ``class_id`` is its
    smallest id; the row that stays has that id, the earliest one where ids repeat.  ``copies``
    counts the rows of the same shingle set, the row itself included, and ``links`` the other
    sets that this one was compared with and found similar to: those that hold the class together.  Texts
    of fewer than ``width`` words are one shingle; texts without a word are alone, each a
    class of its own.  Null texts are empty, null ids are last, no other column is read.
    """
    numbered = docs.select(
        (F.col(row_column) if row_column else F.monotonically_increasing_id()).alias("row"),
        F.col(id_column).alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    )
    if not row_column:
        numbered = stored(numbered, "near-rows")
    sketched = stored(sketches(numbered, width, bands, rows, weighted), "near-sketches")
    # Equal sets are one node, named by its smallest row: copies take no further part.
    same = sketched.filter("size > 0").groupBy("print_a", "print_b")
    nodes = stored(same.agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("copies")), "near-nodes")
    member = sketched.select("row", "print_a", "print_b").join(nodes, ["print_a", "print_b"])
    buckets = (
        sketched.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
        .select(F.col("row").alias("node"), F.col("size").cast("int").alias("size"), F.explode("keys").alias("key"))
    )
    # Tables of their own on both sides let the adaptive skew join cut a bucket that many nodes share.
    shared = stored(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "near-shared")
    buckets = stored(buckets.join(shared, "key"), "near-buckets")
    # A node is the more central, the more company it has in its buckets.
    central = buckets.groupBy("node").agg(F.sum("n").alias("company"))
    buckets = stored(buckets.join(stored(central, "near-central"), "node"), "near-company")
    # One plan at every size: the nodes in question grow with the documents.
    asked = buckets.select(F.col("node").alias("row")).distinct().hint("merge")
    texts = numbered.join(asked, "row", "left_semi").select(F.col("row").alias("node"), "text")
    sets = stored(shingle_sets(texts, width, weighted), "near-sets")
    labels, links = _components(buckets, sets, similarity)
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    labels = labels.join(ends, "node", "left")

    classed = member.join(labels, "node", "left").select("row", F.coalesce("component", "node").alias("class"), "copies", "links")
    whole = sketched.select("row", "doc_id").join(classed, "row", "left")
    whole = stored(
        whole.select(
            "row",
            "doc_id",
            F.coalesce(F.col("class"), F.col("row")).alias("class"),
            F.coalesce("copies", F.lit(1)).alias("copies"),
            F.coalesce("links", F.lit(0)).alias("links"),
        ),
        "near-classes",
    )
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("best")
    # A table of its own, so that the adaptive skew join can cut a class that many rows share.
    heads = stored(whole.groupBy("class").agg(best, F.count(F.lit(1)).alias("class_size")), "near-heads")
    return whole.join(heads, "class").select(
        "row",
        "doc_id",
        F.col("best.doc_id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "copies",
        "links",
    )


def _components(buckets: DataFrame, sets: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(node, component) of all nodes that are similar to another one, and the similar pairs (a, b), each once."""
    alone = buckets.sparkSession.createDataFrame([], "node bigint, component bigint")
    stars = _stars(buckets, alone, "first")
    links = stored(_verified(stars.selectExpr("node AS a", "size AS size_a", "h AS b", "size_h AS size_b"), sets, similarity), "near-links")
    labels = connected_components(links, "near-first")
    more = stored(_linked_apart(_stars(buckets, labels, "second"), sets, similarity), "near-more")
    # What the second search found joins components: only they, few, are connected once more.
    ends = more.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left")
    ends = stored(ends.select("node", F.coalesce("component", "node").alias("component")), "near-ends")
    side = lambda end: ends.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
    between = more.join(side("a"), "a").join(side("b"), "b").filter("of_a <> of_b").selectExpr("of_a AS a", "of_b AS b")
    tops = connected_components(between, "near-second").select(F.col("node").alias("component"), F.col("component").alias("top"))
    whole = labels.unionByName(ends).distinct().join(tops, "component", "left")
    every = links.union(more).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return whole.select("node", F.coalesce("top", "component").alias("component")), every


def _stars(buckets: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(node, size, component) beside (h, size_h, main) of buckets of several components.

    h is the most central member of the bucket's largest component ``main``.  A pair that
    many buckets have stands once.
    """
    named = buckets.join(labels, "node", "left").select(
        "key", "node", "size", F.coalesce("component", "node").alias("component"), (-F.col("company")).alias("company")
    )
    largest = (
        named.groupBy("key", "component")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("company", "node", "size")).alias("head"))
        .groupBy("key")
        .agg(
            F.min(F.struct((-F.col("n")).alias("n"), "head.company", "component", "head")).alias("top"),
            F.count(F.lit(1)).alias("components"),
        )
        .filter("components > 1")
        .selectExpr("key", "top.component AS main", "top.head.node AS h", "top.head.size AS size_h")
    )
    # Tables of their own on both sides let the adaptive skew join cut a bucket that many nodes share.
    largest = stored(largest, f"near-largest-{label}")
    pairs = named.join(largest, "key").filter("node <> h").select("node", "size", "component", "h", "size_h", "main").distinct()
    return stored(pairs, f"near-stars-{label}")


def _linked_apart(stars: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join a group's components: the members of the buckets of one centre h, and h.

    Every set is kept as its difference d from the group's common set; which set that is
    changes the work, not the result.  x and y are similar where d_x and d_y share at least
    slack_x + slack_y shingles.
    """
    members = stars.select("h", "node", "component").union(stars.select("h", F.col("h").alias("node"), F.col("main").alias("component")).distinct())
    # A group of two are the members of a bucket of two, which the first search has compared.
    groups = stored(members.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 2"), "near-groups")
    own = _apart_from_common(stored(members.join(groups, "h"), "near-members"), sets)
    slack = (F.size("d") - (1 - similarity) / (1 + similarity) * F.col("size")) / 2
    own = stored(own.withColumn("slack", slack), "near-own")

    # The member of the least slack first: who shares nothing and is similar to anyone is similar to it.
    best = own.groupBy("h").agg(F.min(F.struct("slack", "node", "component")).alias("best"))
    best = best.select("h", F.col("best.node").alias("z"), F.col("best.component").alias("of_z"), F.col("best.slack").alias("slack_z"))
    best = stored(best, "near-best")
    near_z = stored(best.join(own.selectExpr("h", "node AS z", "size AS size_z", "d AS d_z"), ["h", "z"]), "near-best-sets")
    held = own.join(near_z, "h").filter("component <> of_z").filter(F.size(F.array_intersect("d", "d_z")) >= F.col("slack") + F.col("slack_z") - 1e-9)
    held = stored(held.selectExpr("h", "component", "least(node, z) AS a", "greatest(node, z) AS b", "size AS size_a", "size_z AS size_b"), "near-held")
    direct = stored(_verified(held, sets, similarity), "near-direct")
    # Components with a link to z are one with z's from here on; a group of one is settled.
    one = held.join(direct, ["a", "b"]).select("h", "component").union(best.select("h", F.col("of_z").alias("component"))).distinct()
    one = stored(one.withColumn("joined", F.lit(True)), "near-joined")
    named = own.join(one, ["h", "component"], "left").withColumn("joined", F.coalesce("joined", F.lit(False)))
    named = stored(named.withColumn("component", F.when(F.col("joined"), F.lit(None)).otherwise(F.col("component"))), "near-named")
    others = named.filter("NOT joined").groupBy("h").agg(F.min("slack").alias("slack_other"))
    others = stored(others.join(best.select("h", "slack_z"), "h"), "near-others")

    # Who shares shingles with another component, in order from the rarest on.  Of n shingles, of which k must be
    # shared, one of the first n - k + 1 is shared, on both sides.
    needed = lambda slack: F.greatest(F.ceil(slack - 1e-9), F.lit(1))
    least = needed(F.col("slack") + F.when(F.col("joined"), F.col("slack_other")).otherwise(F.col("slack_z")))
    asked = named.join(others, "h").withColumn("n", F.size("d")).withColumn("last", F.col("n") - least + 1).filter("last > 0")
    asked = asked.withColumn("of", F.coalesce("component", F.lit(-1)))
    each = asked.select("h", "node", "size", "of", "slack", "n", "last", F.explode("d").alias("e"))
    often = (
        each.groupBy("h", "e", "of")
        .agg(F.count(F.lit(1)).alias("f"))
        .groupBy("h", "e")
        .agg(F.sum("f").alias("f"), F.max(F.struct("f", "of")).alias("top"))
        .filter("f > top.f")
        .selectExpr("h", "e", "f", "top.of AS top")
    )
    met = stored(each.join(stored(often, "near-often"), ["h", "e"]), "near-met")
    within = Window.partitionBy("h", "node")
    first = F.col("n") - F.count(F.lit(1)).over(within)  # shingles of one component come first
    met = met.withColumn("rank", first + F.row_number().over(within.orderBy("f", "e"))).filter("rank <= last")
    met = stored(met.select("h", "e", "node", "size", "of", "slack", "n", "rank", (F.col("of") == F.col("top")).alias("top")), "near-early")
    side = lambda end: met.select("h", "e", *(F.col(c).alias(f"{c}_{end}") for c in ("node", "size", "of", "slack", "n", "rank", "top")))
    # The largest component that holds a shingle waits for the others to ask.
    both = needed(F.col("slack_x") + F.col("slack_y"))
    alike = (
        (F.col("of_x") != F.col("of_y"))
        & (F.col("top_y") | (F.col("node_x") < F.col("node_y")))
        & (F.col("rank_x") <= F.col("n_x") - both + 1)
        & (F.col("rank_y") <= F.col("n_y") - both + 1)
        & (F.least("size_x", "size_y") >= F.greatest("size_x", "size_y") * similarity - 1e-9)
    )
    sharing = side("x").filter("NOT top_x").join(side("y"), ["h", "e"]).filter(alike)
    sharing = sharing.selectExpr("least(node_x, node_y) AS a", "greatest(node_x, node_y) AS b", "size_x AS size_a", "size_y AS size_b").distinct()
    return direct.union(_verified(stored(sharing, "near-sharing"), sets, similarity))


def _apart_from_common(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(h, node, component, size, d): d holds what a set has and the group's common set lacks, and the reverse.

    The common set has what most of the group has, so a shingle is in d of half the group at most.
    """
    left = sets.select("node", F.col("members").alias("own"))
    right = sets.select(F.col("node").alias("h"), F.col("members").alias("centre"))

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes = [], []
            for i in range(batch.num_rows):
                own, centre = _unsigned(batch.column(4)[i]), _unsigned(batch.column(5)[i])
                rows += [own[~_held(own, centre)], centre[~_held(centre, own)]]
                sizes.append(len(own))
            lengths = np.array([len(r) for r in rows], dtype=np.int64).reshape(-1, 2).sum(axis=1)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            values = np.concatenate([*rows, np.empty(0, np.uint32)]).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(values))],
                names=["h", "node", "component", "n", "size", "d"],
            )

    held = members.join(left, "node").join(right, "h").select("h", "node", "component", "n", "own", "centre")
    own = stored(held.mapInArrow(differ, "h bigint, node bigint, component bigint, n bigint, size int, d array<int>"), "near-differences")
    most = own.select("h", "n", F.explode("d").alias("e")).groupBy("h", "n", "e").agg(F.count(F.lit(1)).alias("f")).filter("2 * f > n")
    # What most members have and h lacks, or the reverse: as many as two members differ from h by, at most.
    turned = stored(most.groupBy("h").agg(F.collect_list("e").alias("turned")), "near-turned")
    d = F.concat(F.array_except("d", "turned"), F.array_except("turned", "d"))
    return own.join(turned, "h", "left").select("h", "node", "component", "size", F.coalesce(d, F.col("d")).alias("d"))


def _unsigned(members) -> np.ndarray:
    return members.values.to_numpy().view(np.uint32)


def _held(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which values of x are in y; both in order, y not empty."""
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets are similar; lengths that rule it out are not compared."""
    fits = F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * similarity - 1e-9
    pairs = pairs.filter(fits).select("a", "b").distinct()
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("set_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = np.zeros(batch.num_rows, dtype=bool)
            one, two = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                x, y = _unsigned(one[i]), _unsigned(two[i])
                common = int(_held(x, y).sum())
                similar[i] = common >= similarity * (len(x) + len(y) - common) - 1e-9
            yield batch.select([0, 1]).filter(pa.array(similar))

    held = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return held.mapInArrow(compare, "a bigint, b bigint")


def drop_near_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """``docs`` with one row of each class of near-duplicates; all columns stay as they are."""
    name = free_name(docs)
    numbered = stored(docs.withColumn(name, F.monotonically_increasing_id()), "near-numbered")
    classes = near_duplicates(numbered, id_column, text_column, row_column=name, **options)
    stay = classes.filter("kept").select(F.col("row").alias(name))
    return numbered.join(stay, name, "left_semi").drop(name)

"""Cross-tokenizer alignment: which tokens of one vocabulary (A) stand where those of another (B) do.

Both tokenizers cut the same bytes.  Places where both end a token part a text into groups;
inside a group every A token is linked with the B tokens that it shares bytes with.  A pair's
count is the number of documents that hold it linked.

Most links join an A token with the B token of the same bytes.  An array from A id to that B
id is made beforehand; links that follow it, all exact one-to-one groups among them, are
counted in one vector of the vocabulary's length per task.  Only the pairs of irregular groups
are counted in a shuffle.  Texts are tokenised once: each document's distinct links are stored,
counted, and then looked up.  Vectors of the vocabulary's length and the ``CACHED_PAIRS`` most
frequent pairs travel to the tasks; the links of all other pairs meet their counts in a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardledger.llm.common import stored, text_batches
from cardledger.llm.packing import byte_encoder, default_vocabulary

#: Most frequent irregular pairs that every task holds (12 bytes each); the others are joined.
CACHED_PAIRS = 1 << 19
#: Irregular links that a task gathers before it passes their counts on.
COUNTED_LINKS = 4_000_000
#: Tokens spelled out at once.
SPELLED_TOKENS = 1 << 20

DOCUMENT = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
LINKS = "same array<int>, same_n array<int>, pairs array<int>, pair_n array<int>"


@dataclass
class Vocabularies:
    """Bytes of every token of A and B, and the B id of the same bytes for every A id (-1: none)."""

    a: list[bytes]
    b: list[bytes]
    same: np.ndarray

    @property
    def size_b(self) -> int:
        return len(self.b)


def default_paths() -> tuple[str, str]:
    """The public 50k byte-level BPE as ranks (the ids of its tokenizers file), and the 32k pieces."""
    import public_tokenizers

    return default_vocabulary(), public_tokenizers.path("piece_bpe_32k.model")


def load(path_a: str, path_b: str):
    """(encoder of A, encoder of B, vocabularies)."""
    import sentencepiece

    encoder = byte_encoder(path_a)
    pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
    a = [encoder.decode_single_token_bytes(i) for i in range(encoder.n_vocab)]
    b, plain = [], {}
    for i in range(pieces.vocab_size()):
        piece = pieces.id_to_piece(i)
        if pieces.is_byte(i):
            b.append(bytes([int(piece[3:5], 16)]))
        else:
            b.append(piece.replace("▁", " ").encode())
            if not (pieces.is_control(i) or pieces.is_unknown(i)):
                plain.setdefault(b[-1], i)
    for i, token in enumerate(b):
        if pieces.is_byte(i):
            plain.setdefault(token, i)
    same = np.array([plain.get(token, -1) for token in a], dtype=np.int64)
    return encoder, pieces, Vocabularies(a, b, same)


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to size - 1, left-aligned with room for a separator, and their number."""
    names = [str(i).encode() for i in range(size)]
    width = len(names[-1]) + 1
    table = np.frombuffer(b"".join(n.ljust(width, b" ") for n in names), dtype=np.uint8).reshape(size, width)
    return table, np.array([len(n) for n in names], dtype=np.int64)


class Aligner:
    """Aligns batches of texts; one per task."""

    def __init__(self, path_a: str, path_b: str):
        self.encoder, self.pieces, self.words = load(path_a, path_b)
        self.length_a = np.array([len(x) for x in self.words.a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.words.b], dtype=np.int64)
        self.digits, self.n_digits = _digits(max(len(self.words.a), len(self.words.b)))

    def tokens(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """A and B ids of every text, None where a text is empty or either side does not give its bytes."""
        full = [text.decode() for text in texts]
        found = []
        bytes_a, bytes_b = self.words.a.__getitem__, self.words.b.__getitem__
        for raw, text, ids_b in zip(texts, full, self.pieces.encode(full, num_threads=1), strict=True):
            if not raw:
                found.append(None)
                continue
            ids_a = self.encoder.encode_to_numpy(" " + text, disallowed_special=())
            spaced = b" " + raw
            whole = b"".join(map(bytes_a, ids_a.tolist())) == spaced and b"".join(map(bytes_b, ids_b)) == spaced
            found.append((ids_a.astype(np.int64), np.array(ids_b, dtype=np.int64)) if whole else None)
        return found

    def spelled(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The decimal ids, each followed by its separator, and where each one ends."""
        size = self.n_digits[ids]
        rows = self.digits[ids]
        rows[np.arange(len(ids)), size] = ends
        return rows[np.arange(rows.shape[1]) <= size[:, None]], np.cumsum(size + 1)

    def align(self, texts: list[bytes]) -> dict[str, list]:
        """Per text: n_a, n_b, n_groups, n_links, groups (bytes digest) and its distinct links with their numbers."""
        rows = {"n_a": [], "n_b": [], "n_groups": [], "n_links": [], "groups_sha256": []}
        pairs = self.tokens(texts)
        held = np.array([p is not None for p in pairs], dtype=bool)
        kept = [p for p in pairs if p is not None]
        n = np.zeros((4, len(texts)), dtype=np.int64)
        digests = [""] * len(texts)
        links = {name: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for name in ("same", "pairs")}
        counts = {name: np.zeros(len(texts), dtype=np.int64) for name in links}
        if kept:
            a, b = (np.concatenate([p[side] for p in kept]) for side in (0, 1))
            last_a, last_b = (np.cumsum([len(p[side]) for p in kept]) for side in (0, 1))
            ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
            mark = np.zeros(int(ends_a[-1]) + 1, dtype=np.uint8)
            mark[ends_a] = 1
            mark[ends_b] += 2
            common_a, common_b = mark[ends_a] == 3, mark[ends_b] == 3
            # Every stretch between two ends of any kind is what one A and one B token share.
            at = np.flatnonzero(mark)
            kind = mark[at]
            of_a, of_b = kind & 1, kind >> 1
            link_a = a[np.cumsum(of_a) - of_a]
            link_b = b[np.cumsum(of_b) - of_b]
            last_link = np.searchsorted(at, ends_a[last_a - 1], side="right")
            groups = np.cumsum(common_a)[last_a - 1]
            steps = lambda ends: np.diff(ends, prepend=0)
            n[:, held] = steps(last_a), steps(last_b), steps(groups), steps(last_link)
            document = np.repeat(np.flatnonzero(held), n[3, held])

            exact = self.words.same[link_a] == link_b
            size_a, size_b = len(self.words.a), self.words.size_b
            for name, part, size, key in (
                ("same", exact, size_a, link_a),
                ("pairs", ~exact, size_a * size_b, link_a * size_b + link_b),
            ):
                distinct, number = np.unique(document[part] * size + key[part], return_counts=True)
                links[name] = (distinct % size, number)
                counts[name] = np.bincount(distinct // size, minlength=len(texts))

            # Tokens in the order of the groups, A before B in each.
            before_b = np.concatenate([[0], np.flatnonzero(common_b) + 1])[np.cumsum(common_a) - common_a]
            before_a = (np.flatnonzero(common_a) + 1)[np.cumsum(common_b) - common_b]
            place_a, place_b = np.arange(len(a)) + before_b, np.arange(len(b)) + before_a
            ids = np.empty(len(a) + len(b), dtype=np.int64)
            ends = np.empty(len(ids), dtype=np.uint8)
            ids[place_a], ids[place_b] = a, b
            ends[place_a] = np.where(common_a, ord("|"), ord(","))
            ends[place_b] = np.where(common_b, ord(";"), ord(","))
            for i, digest in zip(np.flatnonzero(held), self._digests(ids, ends, last_a + last_b), strict=True):
                digests[i] = digest
        rows |= dict(zip(("n_a", "n_b", "n_groups", "n_links"), n, strict=True))
        rows["groups_sha256"] = digests
        return rows | {"links": links, "counts": counts}

    def _digests(self, ids: np.ndarray, ends: np.ndarray, last: np.ndarray) -> Iterator[str]:
        """SHA-256 of each document's groups; a document of very many tokens is spelled in parts."""
        starts = np.concatenate([[0], last[:-1]])
        first = 0
        while first < len(last):
            beyond = max(first + 1, int(np.searchsorted(last, starts[first] + SPELLED_TOKENS, side="right")))
            low, high = int(starts[first]), int(last[beyond - 1])
            if beyond == first + 1:
                digest = hashlib.sha256()
                for part in range(low, high, SPELLED_TOKENS):
                    text, _ = self.spelled(ids[part : min(part + SPELLED_TOKENS, high)], ends[part : min(part + SPELLED_TOKENS, high)])
                    digest.update(text if part + SPELLED_TOKENS < high else text[:-1])
                yield digest.hexdigest()
            else:
                text, places = self.spelled(ids[low:high], ends[low:high])
                cuts = places[last[first:beyond] - low - 1]
                for begin, end in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
                    yield hashlib.sha256(text[begin : end - 1]).hexdigest()
            first = beyond


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def aligned_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", paths: tuple[str, str] | None = None
) -> DataFrame:
    """Per document: row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and its distinct links.

    ``same`` lists the A ids linked with the B id of the same bytes, ``pairs`` all other links as
    A id times the size of B plus B id; ``same_n`` and ``pair_n`` say how often each occurs.
    """
    path_a, path_b = paths or default_paths()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            for first, texts in text_batches(batch.column(2)):
                found = aligner.align(texts)
                part = batch.slice(first, len(texts))
                lists = []
                for name in ("same", "pairs"):
                    values, numbers = found["links"][name]
                    lists += [_lists(values, found["counts"][name]), _lists(numbers, found["counts"][name])]
                numbers = [pa.array(found[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *numbers, pa.array(found["groups_sha256"], pa.string()), *lists],
                    names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "same", "same_n", "pairs", "pair_n"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    ).mapInArrow(align, f"row bigint, doc_id {kind}, {DOCUMENT}, {LINKS}")


def pair_counts(aligned: DataFrame, same: np.ndarray, size_b: int) -> DataFrame:
    """(a, b, pair, same, documents): how many documents hold each pair linked."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(same), dtype=np.int64)
        waiting, n = [], 0

        def rows(pairs: np.ndarray, documents: np.ndarray, exact: bool) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(pairs), 100_000):
                part = pairs[i : i + 100_000]
                yield pa.RecordBatch.from_pydict(
                    {
                        "pair": pa.array(part.astype(np.int32)),
                        "same": pa.array(np.full(len(part), exact)),
                        "documents": pa.array(documents[i : i + 100_000].astype(np.int64)),
                    }
                )

        for batch in batches:
            vector += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=len(same))
            waiting.append(batch.column(1).flatten().to_numpy(zero_copy_only=False))
            n += len(waiting[-1])
            if n >= COUNTED_LINKS:
                yield from rows(*np.unique(np.concatenate(waiting), return_counts=True), False)
                waiting, n = [], 0
        if waiting:
            yield from rows(*np.unique(np.concatenate(waiting), return_counts=True), False)
        used = np.flatnonzero(vector)
        yield from rows(used * size_b + same[used], vector[used], True)

    counted = (
        aligned.select("same", "pairs")
        .mapInArrow(count, "pair int, same boolean, documents bigint")
        .groupBy("pair", "same")
        .agg(F.sum("documents").alias("documents"))
    )
    return counted.select(
        (F.col("pair") / F.lit(size_b)).cast("int").alias("a"),
        (F.col("pair") % F.lit(size_b)).cast("int").alias("b"),
        "pair",
        "same",
        "documents",
    )


def align_tokenizers(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    paths: tuple[str, str] | None = None,
    cached_pairs: int = CACHED_PAIRS,
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): what every document holds, and every linked pair with its count.

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of
    their A id), count_sum (over links), groups_sha256.  Null and empty texts, and texts whose
    tokens do not give their bytes, have no tokens: zeros and an empty digest.  Repeated rows and
    null ids are documents of their own.  Only the named columns are read.  Pairs: a, b, documents.
    """
    paths = paths or default_paths()
    _, _, words = load(*paths)
    same, size_b = words.same, words.size_b
    aligned = stored(aligned_documents(docs, id_column, text_column, paths), "aligned")
    counts = stored(pair_counts(aligned, same, size_b), "pairs")
    # At most one number per A id each, and cached_pairs pairs.
    highest, exact = np.zeros(len(same), dtype=np.int64), np.zeros(len(same), dtype=np.int64)
    tops = counts.groupBy("a").agg(F.max("documents").alias("documents")).toArrow()
    highest[tops["a"].to_numpy()] = tops["documents"].to_numpy()
    ones = counts.filter("same").select("a", "documents").toArrow()
    exact[ones["a"].to_numpy()] = ones["documents"].to_numpy()
    common = counts.filter("NOT same").select("pair", "documents").orderBy(F.desc("documents"), "pair").limit(cached_pairs).toArrow()
    order = np.argsort(common["pair"].to_numpy())
    known, known_n = common["pair"].to_numpy()[order], common["documents"].to_numpy()[order]
    carried = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sums(values: np.ndarray, lists: pa.Array) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values)])
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            return total[ends[1:]] - total[ends[:-1]]

        for batch in batches:
            row, lists = batch.column(0), {c: batch.column(c) for c in ("same", "same_n", "pairs", "pair_n")}
            a, a_n, pair, pair_n = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists.values())
            place = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            met = known[place] == pair if len(known) else np.zeros(len(pair), dtype=bool)
            number = known_n[place] if len(known) else np.zeros(len(pair), dtype=np.int64)
            found = np.where(met, number, 0)
            count_sum = sums(exact[a] * a_n, lists["same"]) + sums(found * pair_n, lists["pairs"])
            best = sums((exact[a] == highest[a]) * a_n, lists["same"])
            best += sums((met & (found == highest[pair // size_b])) * pair_n, lists["pairs"])
            owner = np.repeat(row.to_numpy(), lists["pairs"].value_lengths().to_numpy(zero_copy_only=False))[~met]
            rare, n_rare = pair[~met], pair_n[~met]
            nothing = lambda kind, n: pa.nulls(n, kind)
            yield pa.RecordBatch.from_arrays(
                [row, *(batch.column(c) for c in carried), pa.array(best), pa.array(count_sum), nothing(pa.int32(), len(row)), nothing(pa.int64(), len(row))],
                names=["row", *carried, "n_best", "count_sum", "pair", "n"],
            )
            for i in range(0, len(rare), 100_000):
                n = len(rare[i : i + 100_000])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(owner[i : i + 100_000]),
                        *(nothing(batch.column(c).type, n) for c in carried),
                        nothing(pa.int64(), n),
                        nothing(pa.int64(), n),
                        pa.array(rare[i : i + 100_000].astype(np.int32)),
                        pa.array(n_rare[i : i + 100_000]),
                    ],
                    names=["row", *carried, "n_best", "count_sum", "pair", "n"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in aligned.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("row", *carried)) + ", n_best bigint, count_sum bigint, pair int, n bigint"
    met = stored(aligned.mapInArrow(look_up, schema), "links")
    tops = F.broadcast(counts.groupBy("a").agg(F.max("documents").alias("highest")))  # a number per A id
    rare_counts = counts.filter("NOT same").join(tops, "a").select("pair", "documents", (F.col("documents") == F.col("highest")).alias("best"))
    rest = (
        met.filter("pair IS NOT NULL")
        .select("row", "pair", "n")
        .join(rare_counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("rest_best"),
            F.sum(F.col("n") * F.col("documents")).alias("rest_sum"),
        )
    )
    documents = (
        met.filter("pair IS NULL")
        .drop("pair", "n")
        .join(rest, "row", "left")
        .select(
            "doc_id",
            "n_a",
            "n_b",
            "n_groups",
            "n_links",
            (F.col("n_best") + F.coalesce("rest_best", F.lit(0))).alias("n_best"),
            (F.col("count_sum") + F.coalesce("rest_sum", F.lit(0))).alias("count_sum"),
            "groups_sha256",
        )
    )
    return documents, counts.select("a", "b", "documents")

"""One query per operator over the whole given tables, and its DuckDB statement where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardledger.llm import (
    alignment,
    contamination,
    exact_dedup,
    licenses,
    minhash,
    mixing,
    neighbours,
    packing,
    passages,
    ppm,
    quality,
    toxicity,
    whitening,
)
from cardledger.llm.common import fold_of, read_table, whole_text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Shares of the mixture for named sources; the others share the rest by their size.
MIXTURE = {"src0": 0.2, "src1": 0.1}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def text_size(column: str = "text"):
    """Code points of a text and one for its end: what the mixture is weighed by."""
    return F.length(whole_text(column)) + 1


@query
def op1_poisson_mix(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix_sources(docs, MIXTURE, size=text_size())
    return mixed.select("doc.doc_id", "doc.source", "doc.text", "copies", "copy", "shuffled")


@query
def op2_toxic_segments(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id")) == 0).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        F.col("toxicity.n_words").alias("n_words"),
        F.col("toxicity.passages").alias("passages"),
    )


@query
def op3_near_copies(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs).drop("row")


@query
def op4_rule_quality(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(docs, read_table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id")) == 0).alias("held_out"),
        F.col("quality.score").alias("score"),
        (F.col("quality.score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op5_vantage_neighbours(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0)


@query
def op6_grouping_pack(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_exact_copies(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.digest_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op8_repeated_passages(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.repeated_passages(docs).drop("row")


@query
def op9_license_blocks(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.license_scan(docs, keep=("doc_id",)).select("doc_id", "license.*")
    blocks = F.aggregate("blocks", F.lit(0), lambda n, run: n + run["blocks"])
    return found.withColumn("n_blocks", blocks).drop("blocks")


@query
def op10_ppm_score(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold_of(F.col("doc_id")) == 1
    scored = ppm.score_texts(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), *scored.columns[1:])


@query
def op11_benchmark_phrases(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.find_leaks(docs, read_table(spark, sf_dir, "benchmark"), keep=("doc_id",))
    return found.select("doc_id", "leak.*").drop("items", "near_items")


@query
def op12_aligned_tokens(spark, sf_dir):
    documents, _ = alignment.align_tokenizers(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return documents


@query
def op13_whitened_vectors(spark, sf_dir):
    return whitening.whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_COPIES_SQL = r"""
WITH texts AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept,
       text_sha256
FROM texts
WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST)
"""

_SHARES = ", ".join(f"('{name}', {share!r})" for name, share in MIXTURE.items())

_MIX_SQL = f"""
WITH shares(source, share) AS (VALUES {_SHARES}),
amounts AS (
    SELECT source, CAST(sum(length(coalesce(text, '')) + 1) AS DOUBLE) AS amount FROM documents GROUP BY source
),
rates AS (
    SELECT a.source,
           coalesce(s.share,
                    (1.0::DOUBLE - (SELECT sum(share::DOUBLE) FROM shares)) * a.amount
                    / (SELECT sum(amount) FROM amounts WHERE source IS NULL OR source NOT IN (SELECT source FROM shares)))::DOUBLE
           * (SELECT sum(amount) FROM amounts) / a.amount AS rate
    FROM amounts a LEFT JOIN shares s ON a.source = s.source
),
terms AS (
    SELECT source, k, exp(ln(rate) * k - rate - lgamma(k + 1)) AS p
    FROM rates, generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT)) AS g(k)
),
steps AS (SELECT source, list(step ORDER BY k) AS steps
          FROM (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS step FROM terms) GROUP BY source),
drawn AS (
    SELECT d.doc_id, d.source, d.text,
           ('0x' || substr(md5('{mixing.SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT
               / 4503599627370496.0::DOUBLE AS u,
           '{mixing.SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, '')) AS name
    FROM documents d
),
counted AS (
    SELECT d.*, CAST(len(list_filter(s.steps, lambda x: x <= d.u)) AS INTEGER) AS copies
    FROM drawn d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, source, text, copies, CAST(c AS INTEGER) AS copy, md5(name || '|' || c) AS shuffled
FROM (SELECT *, unnest(range(copies)) AS c FROM counted)
"""


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _license_sql() -> str:
    """The scan without any filter: every phrase at every place, every template against every block."""
    places, blocks = [], []
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        here = f"list_filter(range(0, len(w) - {len(parts) - 1}), lambda i: w[i + 1:i + {len(parts)}] = {_list(parts)})"
        places.append(f"list_transform({here}, lambda i: {{'at': i, 'label': '{label}'}})")
    for label, template in licenses.TEMPLATES.items():
        held = sorted(set(template.split()))
        shared = f"len(list_intersect(list_distinct(w[i + 1:i + {licenses.BLOCK_WORDS}]), {_list(held)}))"
        least = f"{licenses.THRESHOLD} * {len(held)}"
        here = f"list_filter(starts, lambda i: {shared} >= {least})"
        # A text that holds too few of the words has no block that holds enough.
        here = f"CASE WHEN len(list_intersect(list_distinct(w), {_list(held)})) >= {least} THEN {here} ELSE [] END"
        blocks.append(f"list_transform({here}, lambda i: {{'label': '{label}', 'share': {shared}::DOUBLE / {len(held)}}})")
    concat = lambda parts: " || ".join(parts)
    names = "list_sort(list_distinct(list_transform({}, lambda x: x.label)))"
    return f"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
),
cut AS (SELECT *, range(0, greatest(len(w) - {licenses.BLOCK_WORDS}, 0) + 1) AS starts FROM words),
met AS (SELECT doc_id, len(w) AS n, {concat(places)} AS p, {concat(blocks)} AS b FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(p) AS BIGINT) AS n_base,
       CAST(list_min(list_transform(p, lambda x: x.at)) AS BIGINT) AS first_word,
       CAST(list_max(list_transform(p, lambda x: x.at)) AS BIGINT) AS last_word,
       coalesce(array_to_string({names.format("p")}, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct({names.format("p")} || {names.format("b")})), ','), '') AS labels,
       CASE WHEN len(p) > 0 THEN 1.0 ELSE coalesce(list_max(list_transform(b, lambda x: x.share)), 0.0) END::DOUBLE AS score,
       CAST(len(b) AS INTEGER) AS n_blocks
FROM met"""


_WORDS_SQL = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_LEAKS_SQL = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS_SQL} AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS_SQL} AS w FROM benchmark),
cut AS (
    SELECT DISTINCT item, w[i + 1:i + {contamination.WINDOW_WORDS}] AS win
    FROM (SELECT item, w, unnest(range(0, greatest(len(w) - {contamination.WINDOW_WORDS}, 0) + 1)) AS i FROM items WHERE len(w) > 0)
),
windows AS (SELECT DISTINCT win, len(win) AS n FROM cut),
places AS (SELECT r, i, w[i + 1] AS word FROM (SELECT r, w, unnest(range(0, len(w))) AS i FROM docs)),
starts AS (
    SELECT r, n, unnest(range(0, len(w) - n + 1)) AS i, w FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
),
met AS (
    SELECT s.r, s.i, s.n, s.win FROM (SELECT r, i, n, w[i + 1:i + n] AS win FROM starts) s SEMI JOIN windows v ON s.win = v.win
),
hits AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM met) GROUP BY r),
held AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT m.r, c.item FROM met m JOIN cut c ON m.win = c.win) GROUP BY r
),
counts AS (SELECT word, count(*) AS n FROM places GROUP BY word),
ranked AS (
    SELECT win, arg_min(word, n * 1000 + pos) AS rarest
    FROM (SELECT v.win, u.pos, v.win[u.pos + 1] AS word FROM windows v, unnest(range(0, v.n)) AS u(pos)) JOIN counts USING (word)
    GROUP BY win HAVING count(*) = len(win)
),
near AS (
    SELECT p.r, count(DISTINCT c.item) AS n_near
    FROM places p JOIN ranked k ON p.word = k.rarest JOIN docs d ON d.r = p.r JOIN cut c ON c.win = k.win
    WHERE list_has_all(d.w[greatest(p.i - {contamination.REACH}, 0) + 1:p.i + 1 + {contamination.REACH}], k.win)
    GROUP BY p.r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.listed, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated, CAST(coalesce(n.n_near, 0) AS BIGINT) AS n_near
FROM docs d LEFT JOIN hits h USING (r) LEFT JOIN held i USING (r) LEFT JOIN near n USING (r)
"""


def oracle_statements() -> dict[str, str]:
    return {
        "op1_poisson_mix": _MIX_SQL,
        "op7_exact_copies": _COPIES_SQL,
        "op9_license_blocks": _license_sql(),
        "op11_benchmark_phrases": _LEAKS_SQL,
    }

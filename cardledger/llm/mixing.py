"""Mixing sources to target weights by Poisson replication.

Every source has a mean repetition rate, its target share of the mixture over what
it has.  A document's number of copies is the quantile of the Poisson distribution
with that mean at a uniform number hashed from the document and a seed: the same
document gets the same count wherever and however often the job runs.  Copies are
then dealt over all partitions by a hash of document and copy, and sorted by it.
All of it is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.llm.common import stored, whole_text

SEED = 20240501


def source_rates(
    docs: DataFrame, weights: Mapping[str, float], source_column: str = "source", size: Column | None = None
) -> DataFrame:
    """(source, amount, rate): mean repetitions of each source.

    ``weights`` holds shares of the mixture (each in 0..1, together at most 1).  Sources
    without one share the rest in proportion to their amount.  The mixture is as large
    as the input; where named sources are absent it is smaller by their share.
    """
    if any(not 0 <= w <= 1 for w in weights.values()) or sum(weights.values()) > 1 + 1e-9:
        raise ValueError("weights are shares between 0 and 1 of one mixture")
    amounts = docs.groupBy(F.col(source_column).cast("string").alias("source")).agg(
        F.sum(F.lit(1) if size is None else size).cast("double").alias("amount")
    )
    amounts = stored(amounts, "amounts")
    weight = F.lit(None).cast("double")
    for name, share in weights.items():
        weight = F.when(F.col("source") == name, F.lit(float(share))).otherwise(weight)
    totals = amounts.select("amount", weight.alias("weight")).agg(
        F.sum("amount").alias("total"),
        F.sum(F.when(F.col("weight").isNull(), F.col("amount"))).alias("unnamed"),
    )
    total, unnamed = totals.first()
    share = F.coalesce(weight, F.lit(1.0 - sum(weights.values())) * F.col("amount") / F.lit(float(unnamed or 1)))
    rate = F.when(F.col("amount") > 0, share * F.lit(float(total or 0)) / F.col("amount")).otherwise(0.0)
    return amounts.select("source", "amount", rate.alias("rate"))


def poisson_copies(rate: Column, drawn: Column) -> Column:
    """The quantile of a Poisson distribution at ``drawn``, a number in [0, 1): how many steps of it lie at or below.

    Probabilities are summed from 0 on, in plain numbers while the first one is not too small
    for a double.  Beyond that the sum starts 25 standard deviations below the mean: all that is
    left out is far below the last digit, and the steps grow with the root of the rate.
    """
    from_start = F.lit(700.0)
    low = F.when(rate <= from_start, F.lit(0)).otherwise(F.floor(rate - 25 * F.sqrt(rate))).cast("long")
    low = F.greatest(low, F.lit(0).cast("long"))
    steps = F.ceil(F.when(rate <= from_start, rate + 12 * F.sqrt(rate) + 40).otherwise(37 * F.sqrt(rate) + 40)).cast("int")
    k = low.cast("double")
    # log of k!: exact sums are not needed, the series is good to the last digits beyond 100.
    log_factorial = F.when(k > 0, k * F.log(k) - k + 0.5 * F.log(2 * F.pi() * k) + 1 / (12 * k) - 1 / (360 * k * k * k)).otherwise(0.0)
    first = F.when(rate > 0, F.exp(F.log(rate) * k - rate - log_factorial)).otherwise(1.0)
    start = F.struct(first.alias("p"), first.alias("sum"), low.alias("k"), F.lit(True).alias("going"))

    def step(state: Column, i: Column) -> Column:
        # Still going: the sum up to k is at or below the drawn number, so k + 1 copies are reached.
        going = state["going"] & (state["sum"] <= drawn) & (state["p"] >= 0)
        k = state["k"] + going.cast("long")
        p = F.when(going, state["p"] * rate / k).otherwise(state["p"])
        total = F.when(going, state["sum"] + p).otherwise(state["sum"])
        return F.struct(p.alias("p"), total.alias("sum"), k.alias("k"), going.alias("going"))

    reached = F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda state: state["k"])
    return F.when(drawn > 0, reached).otherwise(F.lit(0).cast("long"))  # below every step


def hashed_uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float],
    seed: int = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    size: Column | None = None,
) -> DataFrame:
    """The columns of ``docs`` in a struct ``doc``, with copies, copy (from 0) and rate.

    Rows are ordered at random over all partitions.  A null source is a source of its
    own, a null id counts as empty text, and repeated rows get equal counts.  Amounts
    are rows unless ``size`` says otherwise.  An empty table gives an empty mixture.
    """
    rates = stored(source_rates(docs, weights, source_column, size), "rates")
    copies = poisson_copies(F.col("rate"), F.col("drawn")).cast("int")
    key = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    body = F.md5(whole_text(text_column))
    drawn = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(source_column).cast("string").alias("own_source"),
        hashed_uniform(F.lit(str(seed)), key).alias("drawn"),
        F.concat_ws("|", F.lit(str(seed)), key, body).alias("name"),
    )
    return (
        drawn.join(rates, F.col("own_source").eqNullSafe(F.col("source")))
        .select("doc", "rate", "name", copies.alias("copies"))
        .filter("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        .withColumn("shuffled", F.md5(F.concat_ws("|", "name", F.col("copy").cast("string"))))
        .repartition("shuffled")
        .sortWithinPartitions("shuffled")
        .select("doc", "copies", "copy", "rate", "shuffled")
    )

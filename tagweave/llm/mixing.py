"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Every document is repeated ``k`` times, where ``k`` is the inverse of the
Poisson distribution function at a uniform number drawn from the hash of
(seed, doc_id). The mean is the repetition rate that its source needs to reach
its target share, so that no row has to know how many copies others got: no
quota, no coordination, the same draw on every retry.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, without

#: The distributions of all sources are broadcast if they have at most so many values of 8 bytes in all (a source counts as 50 and its name).
BROADCAST_VALUES = 1 << 21
#: The distribution is tabulated this many standard deviations, and 20 more counts, to both sides of its mean:
#: the rest is below 1e-30, a draw has 52 bits.
DEVIATIONS = 12


def uniform(seed: str, *parts: Column) -> Column:
    """52 bits of md5 as a number in [0, 1)."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def log_factorial(n: Column) -> Column:
    """Stirling's series, to double precision from 20 on."""
    x = n.cast("double")
    return x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3.0)))


def poisson_cdf(rate: Column) -> Column:
    """``(first, cdf)``: the Poisson distribution function at ``first``, ``first`` + 1, ..., round its mean; null for rate 0.

    Values below ``first`` are 0 to any draw, so the table has some ``24 * sqrt(rate) + 40`` of them.
    """
    reach = DEVIATIONS * F.sqrt(rate) + 20
    last = F.ceil(rate + reach).cast("int")
    first = F.when(rate - reach >= 20, F.floor(rate - reach)).otherwise(0).cast("int")
    log_p = F.when(first > 0, first * F.log(rate) - rate - log_factorial(first)).otherwise(-rate)
    state = F.struct(log_p.alias("lp"), F.exp(log_p).alias("c"), F.array(F.exp(log_p)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        lp = acc["lp"] + F.log(rate) - F.log(k.cast("double"))
        c = acc["c"] + F.exp(lp)
        return F.struct(lp.alias("lp"), c.alias("c"), F.array_append(acc["cdf"], c).alias("cdf"))

    cdf = F.aggregate(F.sequence(first + 1, last), state, step, lambda acc: acc["cdf"])
    return F.when(rate > 0, F.struct(first.alias("first"), cdf.alias("cdf")))


def source_rates(docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.7,
                 total_rows: int | None = None) -> tuple[DataFrame, int]:
    """``(source, n_rows, rate)`` for each source, and a bound on the values that ``poisson_cdf`` has for all of them.

    ``weights``: ``(source, weight)``, one row for each source; sources
    that it does not name get rate 0, weights of sources without rows are left out. Without it, a source's weight is its row
    count to the power ``temperature``, which flattens the mixture. The rates
    add up to ``total_rows`` expected rows (default: as many as come in).
    """
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))
    if weights is None:
        counts = counts.withColumn("weight", F.pow(F.col("n_rows").cast("double"), F.lit(temperature)))
    else:
        w = weights.groupBy(F.col("source").alias("_source")).agg(F.max("weight").cast("double").alias("weight"))
        counts = counts.join(w, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    weight = F.when(F.col("weight") > 0, F.col("weight")).otherwise(0.0)
    n, rows, total, roots, names = counts.agg(F.count(F.lit(1)), F.sum("n_rows"), F.sum(weight), F.sum(F.sqrt(weight / F.col("n_rows"))),
                                              F.sum(F.octet_length("source"))).first()
    rows = rows if total_rows is None else total_rows
    values = 50 * n + (names or 0) / 8 + 2 * DEVIATIONS * (roots or 0) * math.sqrt((rows or 0) / (total or 1))
    rate = weight * F.lit(float(rows or 0)) / F.lit(float(total or 1)) / F.col("n_rows")
    return counts.select("source", "n_rows", rate.alias("rate")), math.ceil(values)


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.7,
                total_rows: int | None = None, seed: str = "mix-1", copy_column: str = "copy_no") -> DataFrame:
    """Documents repeated to the target mixture, in shuffled order.

    All columns of ``docs`` plus ``copy_column`` (1, 2, ...; an input column of
    that name is replaced). A null source is a source of its own; null or empty
    texts are rows like any other; rows with the same doc_id get the same
    number of copies; a null doc_id draws as the word ``null``; no rows in, no rows out.

    Plan: one aggregate over ``source`` alone, a broadcast of the distributions (a
    shuffled join beyond ``BROADCAST_VALUES``), the explode, and one shuffle on the hash of
    (doc_id, copy): rows of a hot source spread like all others. Within
    a partition rows are sorted by the same hash, so the order of
    the output is a pseudo-random permutation.
    """
    docs = without(docs, copy_column)
    rates, n_values = source_rates(docs, weights, temperature, total_rows)
    source, cdf, key = fresh(docs, "rate_source"), fresh(docs, "cdf"), fresh(docs, "shuffle_key")
    rates = rates.select(F.col("source").alias(source), poisson_cdf(F.col("rate")).alias(cdf))
    if n_values <= BROADCAST_VALUES:
        rates = F.broadcast(rates)
    u = uniform(seed, F.col("doc_id"))
    copies = F.when(F.col(cdf).isNull(), 0).otherwise(F.col(cdf)["first"] + F.size(F.filter(F.col(cdf)["cdf"], lambda c: c <= u)))
    out = docs.join(rates, F.col("source").eqNullSafe(F.col(source)), "inner").withColumn(cdf, copies)
    out = out.where(F.col(cdf) > 0).withColumn(copy_column, F.explode(F.sequence(F.lit(1), F.col(cdf))))
    out = out.withColumn(key, F.xxhash64(F.lit(seed), F.col("doc_id"), F.col(copy_column)))
    return out.repartition(F.col(key)).sortWithinPartitions(key).select(*[F.col(f"`{c}`") for c in (*docs.columns, copy_column)])


#: DuckDB twin of ``mix_sources(docs)`` over a relation ``{docs}`` with the columns of documents.
MIX_SQL = """
WITH src AS (
  SELECT source, count(*) AS n_rows, pow(count(*)::DOUBLE, {temperature}) AS weight FROM {docs} GROUP BY source),
rates AS (
  SELECT source, weight * (SELECT sum(n_rows) FROM src)::DOUBLE / (SELECT sum(weight) FROM src) / n_rows AS rate FROM src),
terms AS (
  SELECT source, rate, k,
         exp(k * ln(rate) - rate - coalesce(lgamma_k, 0)) AS p
  FROM rates, (SELECT k, sum(CASE WHEN k = 0 THEN 0 ELSE ln(k) END) OVER (ORDER BY k) AS lgamma_k
               FROM (SELECT unnest(range(0, 2000)) AS k))
  WHERE k <= ceil(rate + 12 * sqrt(rate) + 20)),
cdf AS (
  SELECT source, list(c ORDER BY k) AS cdf
  FROM (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms) GROUP BY source),
drawn AS (
  SELECT d.*, len(list_filter(cdf, lambda c: c <= ('0x' || substr(md5('{seed}:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / pow(2, 52))) AS n_copies
  FROM {docs} d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, n_copies + 1))::INT AS copy_no FROM drawn
"""

"""Mixing sources to target weights by Poisson replication, with DataFrame functions alone.

The target weight of a source asks for a number of characters in the mix; divided by what the source has, it is the mean
repetition rate of the source's documents. Each document gets a uniform number from a seeded hash of its doc_id, and the
Poisson distribution of its source's rate is inverted at it: the number of copies is the number of cumulative
probabilities that lie at or below it. A rate above `MOST_RATE`, where exp(-rate) comes near to vanishing, is split evenly
into several draws with seeds of their own, whose sum has the same distribution. Copies are exploded and the whole is put
in the order of a second hash.

The table of sources is aggregated map-side first, written, and measured: up to `MOST_BROADCAST_BYTES`, its cumulative
probabilities included, it is broadcast, so that texts are not dealt by source at all; above that both sides are shuffled
and a hot source is split by adaptive execution. Copies of one document have different hash keys, so the global shuffle is
even whatever the sources.

Defined results: a null source is a source of its own; a null text has 0 characters (a source of none but such texts gets
rate 1); a source without a weight gets rate 0 when `weights` is given; a null doc_id draws the number of the string
'null'; repeated rows draw the same number; an empty table gives no rows. Extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomrank.session import written

#: The table of rates is broadcast up to this size; a source takes some hundreds of bytes, at high rates up to 6 KB.
MOST_BROADCAST_BYTES = 64 << 20
#: Mean of a single draw at most.
MOST_RATE = 500
#: Uniform numbers are multiples of 2 ** -52, read from 13 hex digits of an MD5 digest.
DIGITS = 13


def uniform(key: Column, seed: str, draw: Column | None = None) -> Column:
    """A number in [0, 1) from a seeded hash of key; draw: number of a further draw."""
    start = F.lit(f"{seed}:") if draw is None else F.concat(F.lit(f"{seed}+"), draw.cast("string"), F.lit(":"))
    digest = F.md5(F.concat(start, F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def poisson_cdf(rate: Column) -> Column:
    """Array of P(X <= k) for k = 0, 1, ... as far as 10 standard deviations above the mean, by the recurrence of terms."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 10).cast("int")
    first = F.exp(-rate)
    step = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(first.alias("p"), F.array(first).alias("c")),
        lambda acc, k: F.struct((acc.p * rate / k).alias("p"), F.concat(acc.c, F.array(F.element_at(acc.c, -1) + acc.p * rate / k)).alias("c")),
    )
    return step.c


def source_rates(docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.5, total_chars: int | None = None) -> DataFrame:
    """(source, rate, draws, cdf), the cdf that of each draw. weights(source, weight): any positive scale; None: characters
    to the power of temperature.

    total_chars: size of the mix; None: as many as the input has.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("double").alias("chars"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow("chars", F.lit(temperature)))
    else:
        w = weights.groupBy(F.col("source").alias("w_source")).agg(F.sum("weight").cast("double").alias("weight"))
        weighed = sizes.join(w, sizes["source"].eqNullSafe(w["w_source"]), "left").select(sizes["source"], "chars", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    sums = weighed.agg(F.sum("chars").alias("all_chars"), F.sum("weight").alias("all_weight"))
    goal = F.lit(float(total_chars)) if total_chars is not None else F.col("all_chars")
    rate = F.when(F.col("chars") > 0, F.col("weight") / F.col("all_weight") * goal / F.col("chars")).otherwise(F.lit(1.0))
    rated = weighed.crossJoin(F.broadcast(sums)).select("source", rate.alias("rate"))  # sums is one row
    rated = rated.withColumn("rate", F.coalesce("rate", F.lit(0.0)))
    rated = rated.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / MOST_RATE)).cast("int"))
    return rated.withColumn("cdf", poisson_cdf(F.col("rate") / F.col("draws")))


def mix(docs: DataFrame, rates: DataFrame, seed: str = "mix") -> DataFrame:
    """docs, each row as often as its draw says, with copy_no and mix_key, in ascending order of mix_key. Columns of these
    two names in the input are replaced."""
    docs = docs.drop("copy_no", "mix_key")
    r = written(rates.select(F.col("source").alias("_s"), F.col("draws").alias("_draws"), F.col("cdf").alias("_cdf")), "rates")
    held = r.agg(F.sum(F.lit(64) + F.coalesce(F.octet_length("_s"), F.lit(0)) + 8 * F.size("_cdf"))).first()[0] or 0
    if held <= MOST_BROADCAST_BYTES:
        r = F.broadcast(r)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("_id"), F.col("source").alias("_source"))
    n = F.size(F.filter("_cdf", lambda c: c <= uniform(F.col("_id"), seed)))
    more = F.aggregate(F.sequence(F.lit(1), F.col("_draws") - 1), F.lit(0), lambda sum_, i: sum_ + F.size(F.filter("_cdf", lambda c: c <= uniform(F.col("_id"), seed, i))))
    n = F.when(F.col("_draws") > 1, n + more).otherwise(n)
    drawn = rows.join(r, rows["_source"].eqNullSafe(r["_s"])).select("row", "_id", n.alias("_n")).where("_n > 0")
    copies = drawn.select("row", "_id", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy_no"))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), F.coalesce(F.col("_id").cast("string"), F.lit("null")), F.col("copy_no")))
    keyed = copies.withColumn("mix_key", F.conv(F.substring(key, 1, 15), 16, 10).cast("long"))
    return keyed.orderBy("mix_key", "_id", "copy_no").select("row.*", "copy_no", "mix_key")


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs, source_rates(docs)).select("doc_id", "source", "copy_no", "mix_key", F.length("text").cast("long").alias("chars"), "text")


#: The same by DuckDB, each term from its logarithm; as many terms and draws as the rates ask for.
SQL = f"""
WITH sizes AS (SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS chars FROM documents GROUP BY source),
w AS (SELECT source, chars, pow(chars, 0.5e0) AS weight FROM sizes),
s AS (SELECT sum(chars) AS all_chars, sum(weight) AS all_weight FROM w),
e AS (SELECT source, CASE WHEN chars > 0 THEN weight / all_weight * all_chars / chars ELSE 1e0 END AS rate FROM w, s),
r AS (SELECT source, CAST(greatest(1, ceil(rate / {MOST_RATE})) AS INTEGER) AS draws, rate / greatest(1, ceil(rate / {MOST_RATE})) AS mean FROM e),
t AS (SELECT source, k, exp(k * ln(mean) - mean - CASE WHEN k = 0 THEN 0 ELSE lgamma(k + 1) END) AS p
      FROM r, range(0, {MOST_RATE + 10 * 23 + 11}) AS g(k) WHERE k <= ceil(mean + 10 * sqrt(mean) + 10)),
c AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM t),
d AS (SELECT row_number() OVER () AS id, doc_id, source, text, coalesce(CAST(doc_id AS VARCHAR), 'null') AS name FROM documents),
i AS (SELECT d.id, d.source, d.name, unnest(range(0, draws)) AS draw FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
u AS (SELECT id, source, CAST(CAST('0x' || substr(md5('mix' || CASE WHEN draw > 0 THEN '+' || draw ELSE '' END || ':' || name), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496e0 AS u FROM i),
n AS (SELECT u.id, count(*) AS n FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source WHERE c.cdf <= u.u GROUP BY u.id)
SELECT doc_id, source, CAST(copy_no AS INTEGER) AS copy_no,
       CAST('0x' || substr(md5('mix-order:' || name || ':' || CAST(copy_no AS VARCHAR)), 1, 15) AS BIGINT) AS mix_key,
       CAST(length(text) AS BIGINT) AS chars, text
FROM (SELECT d.*, unnest(range(1, n + 1)) AS copy_no FROM d JOIN n ON d.id = n.id)
"""

"""Mix sources to target weights by Poisson replication.

The target weight of a source and its share of the characters give the mean number of times each of
its documents is repeated. A document's count is the Poisson quantile, at that mean, of a uniform
number hashed from a seed and its id: the same in every run, and drawn without a shuffle. Rows are
then exploded by their count and dealt out again by a hash of (seed, id, copy).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import cut, table

SEED = "mix-1"
#: Rate tables of at most so many sources are broadcast (some 10 MB); larger ones are joined.
BROADCAST_SOURCES = 100_000
#: Larger means are drawn as sums, so that exp(-mean) stays a normal number.
LARGEST_MEAN = 64.0
#: Beyond this count the quantile at a mean of 64 has passed every 52-bit uniform number.
LARGEST_COUNT = 160
#: Parts of a sum at most; a larger mean than LARGEST_MEAN * MOST_PARTS is inverted by its expansion.
MOST_PARTS = 64
#: Copies that one row is exploded into at once. Rows with more are dealt out in chunks first.
CHUNK = 10_000


def uniform(seed: str, key: Column, part: Column | None = None) -> Column:
    """A number in (0, 1) from 52 bits of an MD5 hash."""
    pieces = [F.lit(seed), key] + ([part.cast("string")] if part is not None else [])
    return (F.conv(F.substring(F.md5(F.concat_ws("|", *pieces)), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def poisson_levels(mean: Column) -> Column:
    """Cumulative probabilities of 0, 1, ... for a mean up to LARGEST_MEAN, as far as they are below 1."""
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(state["cdf"], F.array(F.element_at(state["cdf"], -1) + p)).alias("cdf"))

    levels = F.aggregate(F.sequence(F.lit(1), F.lit(LARGEST_COUNT)), start, step, lambda state: state["cdf"])
    return F.filter(levels, lambda level: level < 1.0)


def poisson_quantile(u: Column, levels: Column) -> Column:
    """The smallest count whose cumulative probability is at least u."""
    return F.size(F.filter(levels, lambda level: level < u))


# Coefficients of a rational approximation to the normal quantile (error below 1.2e-9),
# numerator and denominator, for the middle and for the tails.
_MIDDLE = ((-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02,
            -3.066479806614716e+01, 2.506628277459239e+00),
           (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01,
            -1.328068155288572e+01, 1.0))
_TAIL = ((-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00,
          4.374664141464968e+00, 2.938163982698783e+00),
         (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00, 1.0))
_EDGE = 0.02425


def _polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + c
    return value


def normal_quantile(u: Column) -> Column:
    """The standard normal deviate below which a share u lies."""
    near, root = u - 0.5, F.sqrt(-2 * F.ln(F.least(u, 1 - u)))
    middle = near * _polynomial(near * near, _MIDDLE[0]) / _polynomial(near * near, _MIDDLE[1])
    tail = _polynomial(root, _TAIL[0]) / _polynomial(root, _TAIL[1])
    return F.when((u >= _EDGE) & (u <= 1 - _EDGE), middle).otherwise(F.when(u < 0.5, tail).otherwise(-tail))


def large_poisson_quantile(u: Column, mean: Column) -> Column:
    """The Poisson quantile at a large mean, from the normal one by the first terms of its expansion.
    At means of some thousands it is off by one at most, and seldom."""
    z = normal_quantile(u)
    return F.greatest(F.lit(0.0), F.floor(
        mean + F.sqrt(mean) * z + (z * z + 2) / 6 + (-z * z * z - 2 * z) / (72 * F.sqrt(mean)))).cast("long")


def source_rates(docs: DataFrame, weights: dict[str, float] | None, source_col: str, text_col: str) -> DataFrame:
    """(`source`, `rate`, `parts`, `levels`): the mean repetition of each source's documents at the target
    weights, in how many equal parts it is drawn (0: not in parts, as it is too large), and the
    cumulative probabilities of a part. The mix is as large as the input. A source of empty texts alone
    has rate 1 (0 if it has no weight)."""
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(F.length(F.coalesce(F.col(text_col), F.lit("")))).alias("size"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else None
        weight = F.coalesce(given[F.col("source")], F.lit(0.0)) if weights else F.lit(0.0)
    weighed = cut(sizes.withColumn("weight", weight.cast("double")))
    total = weighed.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    scale = F.lit(float(total["size"] or 0) / (total["weight"] or 1.0))
    rates = weighed.select("source", F.when(F.col("size") > 0, F.col("weight") * scale / F.col("size")).otherwise(
        F.when(F.col("weight") > 0, 1.0).otherwise(0.0)).alias("rate"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST_MEAN))
    rates = rates.withColumn("parts", F.when(parts <= MOST_PARTS, parts).otherwise(F.lit(0)).cast("int"))
    return cut(rates.withColumn("levels", F.when(F.col("parts") > 0, poisson_levels(F.col("rate") / F.col("parts")))))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, seed: str = SEED, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source", copy_col: str | None = None) -> DataFrame:
    """The documents, repeated (or left out) to reach the target weights, in shuffled order.

    All columns stay; copy_col names an added column with the copy's number, from 1 on. Without
    weights every source gets the same; with weights, a source that isn't listed gets none. No source
    is a source of its own; no text is an empty one. Rows without an id draw by their text. Rows that
    repeat an id draw the same count. An empty table gives an empty result.

    A row of many copies, as of a source with few texts, is dealt out to the tasks in chunks of copies
    before those are made.
    """
    rates = source_rates(docs, weights, source_col, text_col)
    sizes = rates.agg(F.count("*").alias("n"), F.max("rate").alias("most"), F.min("parts").alias("fewest_parts"),
                      F.max("parts").alias("most_parts")).first()
    if sizes["n"] <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    # Plain columns under names of their own, which no column of the documents clashes with.
    own = {name: f"_own_{i}" for i, name in enumerate(docs.columns)}
    key = F.coalesce(F.col(own[id_col]).cast("string"), F.concat(
        F.lit("text:"), F.md5(F.coalesce(F.col(own[text_col]), F.lit("")))))
    rows = docs.toDF(*own.values()).join(
        rates.select(F.col("source").alias("_of"), "rate", "parts", "levels"), F.col(own[source_col]).eqNullSafe(F.col("_of")))
    rows = rows.select(*own.values(), key.alias("key"), "rate", "parts", "levels")
    one = poisson_quantile(uniform(seed, F.col("key")), F.col("levels"))
    many = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda sum_, i: sum_ + poisson_quantile(
        uniform(seed, F.col("key"), i), F.col("levels")))
    large = large_poisson_quantile(uniform(seed, F.col("key")), F.col("rate"))
    # Only the forms that some source needs: the code of all of them together is too long to be compiled.
    copies = one
    if (sizes["most_parts"] or 0) > 1:
        copies = F.when(F.col("parts") == 1, one).otherwise(many)
    if sizes["fewest_parts"] == 0:
        copies = F.when(F.col("parts") == 0, large).otherwise(copies)
    copies = copies.cast("long")
    rows = rows.select(*own.values(), "key", copies.alias("copies")).where("copies > 0")
    zero = F.lit(0).cast("long")
    if (sizes["most"] or 0) < CHUNK / 10:
        rows = rows.withColumn("chunk", zero)
    else:
        chunks = F.explode(F.sequence(zero, F.expr(f"(copies - 1) div {CHUNK}")))
        rows = rows.select(*own.values(), "key", "copies", chunks.alias("chunk")).repartition("key", "chunk")
    rows = rows.select(*own.values(), "key", F.explode(F.sequence(
        F.col("chunk") * CHUNK + 1, F.least(F.col("copies"), (F.col("chunk") + 1) * CHUNK))).alias("copy"))
    place = F.xxhash64(F.lit(seed), F.col("key"), F.col("copy"))
    rows = rows.withColumn("place", place).repartition("place").sortWithinPartitions("place")
    return rows.select(*[F.col(own_name).alias(name) for name, own_name in own.items()],
                       *([F.col("copy").alias(copy_col)] if copy_col else []))


def op10_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents"), copy_col="copy").withColumn("copy", F.col("copy").cast("int"))


OP10_SQL = f"""
WITH sizes AS (
  SELECT source, sum(length(coalesce(text, ''))) AS size, 1.0::DOUBLE AS weight FROM documents GROUP BY source),
rates AS (
  SELECT source, CASE WHEN size > 0 THEN weight * ((SELECT sum(size) FROM sizes)::DOUBLE / (SELECT sum(weight) FROM sizes)) / size
                      ELSE 1.0 END AS rate FROM sizes),
drawn AS (
  SELECT d.*, rate, (('0x' || substr(md5('{SEED}|' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
levels AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM (SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p FROM rates, range(0, {LARGEST_COUNT}) t(k))),
counted AS (
  SELECT doc_id, text, lang, source, n_chars,
         (SELECT count(*) FROM levels l WHERE l.source IS NOT DISTINCT FROM drawn.source AND l.cdf < drawn.u) AS copies
  FROM drawn)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, copies + 1))::INTEGER AS copy FROM counted
"""
assert math.exp(-LARGEST_MEAN) > 0

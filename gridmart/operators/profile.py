"""Column profile of a table: type, counts, range, moments and quartiles of every column."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.cleaning import null_if_nan
from ..functions.dates import iso_date

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
_STATS = ("data_type", "non_null", "nulls", "min", "max", "avg", "stddev", *QUARTILES, "distinct")

#: Buckets a round of the exact quartiles cuts a range of numbers into.
SPLIT = 1 << 22


def _is_number_type(kind: str) -> bool:
    return kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")


def _fitting(kind: str, totals: Row) -> str:
    """The type that all texts of a column fit: bigint, double or date, else string; other types stay."""
    if kind != "string" or not totals.non_null:
        return kind
    counts = {"bigint": totals.whole, "double": totals.numbers, "date": totals.dates}
    return next((name for name, n in counts.items() if n == totals.non_null), "string")


def _local(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows as a relation of the plan itself, which needs no job to be read."""
    fields = T.StructType.fromDDL(schema)
    columns = [pa.array([row[i] for row in rows], to_arrow_type(f.dataType)) for i, f in enumerate(fields)]
    return spark.createDataFrame(pa.table(columns, names=fields.names), fields)


# ---- exact ---------------------------------------------------------------------------------


def _values(df: DataFrame) -> DataFrame:
    """(column number, value as text, how often, value as number): every cell once, frequent values
    folded in the tasks. All that follows reads these counts, so a cell is parsed once per value."""
    cells = F.array(*[F.col(f"`{name}`").cast("string") for name in df.columns])
    counts = df.select(F.posexplode(cells).alias("c", "value")).groupBy("c", "value").agg(F.count("*").alias("n"))
    numeric = [i for i, (_, kind) in enumerate(df.dtypes) if kind == "string" or _is_number_type(kind)]
    return counts.withColumn("number", F.when(F.col("c").isin(numeric), F.col("value").try_cast("double")))


def _first_bytes(value: Column) -> Column:
    """The first 7 bytes of a text as a number: its least and greatest find the texts to compare."""
    return F.conv(F.rpad(F.hex(F.substring(value.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")


def _sum_if(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def _totals(values: DataFrame, texts: list[int]) -> DataFrame:
    """One line per column: counts, the ends of its numbers and those of its texts' first bytes."""
    value, number, text = F.col("value"), null_if_nan(F.col("number")), F.col("c").isin(texts)
    # What is a number is neither parsed as a date nor compared as text, unless its column is no number.
    return values.groupBy("c").agg(
        F.sum("n").alias("n_rows"), _sum_if(value.isNotNull()).alias("non_null"), F.count("value").alias("distinct"),
        _sum_if(text & value.try_cast("bigint").isNotNull()).alias("whole"), _sum_if(F.col("number").isNotNull()).alias("numbers"),
        _sum_if(text & F.col("number").isNull() & iso_date(value).isNotNull()).alias("dates"),
        _sum_if(number.isNotNull()).alias("counted"), F.min(number).alias("low"), F.max(number).alias("high"),
        F.min(_first_bytes(value)).alias("first"), F.max(_first_bytes(value)).alias("last"),
        F.try_divide(F.sum(number * F.col("n")), _sum_if(number.isNotNull())).alias("mean"))


def _order_of_magnitude(number: Column) -> Column:
    """Grows with the number; equal steps are equal factors (746 is above -ln of the least double)."""
    return F.when(number == 0, F.lit(0.0)).otherwise(F.signum(number) * (F.ln(F.abs(number)) + 746))


def _bucket(number: Column, low: Column, high: Column) -> Column:
    """The bucket of a number between two ends; it never falls while the number grows."""
    return F.coalesce(F.floor(F.try_divide(number - low, high - low) * SPLIT), F.lit(0))


def _ranks(counted: int) -> dict[str, tuple[int, int, float]]:
    """Per quartile the ranks (from 0) of the numbers around it, and its place between them."""
    places = {name: (counted - 1) * q for name, q in QUARTILES.items()}
    return {name: (math.floor(at), math.ceil(at), at - math.floor(at)) for name, at in places.items()}


def _refined(numbers: DataFrame, ranges: list[tuple], first: bool) -> list:
    """Cut ranges of numbers (column, numbers of the column before it, its ends, mean, wanted ranks) into
    buckets; the buckets that hold a wanted rank, with the ends of what is in them.

    A column has at most two wanted ranks for each quartile, so the ranges to send to the tasks and
    the rows that come back are six for each column at most. The running count of a range goes over
    SPLIT buckets at most.
    """
    schema = "of int, start long, low double, high double, mean double, ranks array<long>"
    wanted = F.broadcast(_local(numbers.sparkSession, ranges, schema))
    inside = numbers.join(wanted, (F.col("c") == F.col("of")) & F.col("number").between(F.col("low"), F.col("high")))
    ends = [F.col(name) for name in ("number", "low", "high")]
    bucket = _bucket(*(_order_of_magnitude(x) for x in ends) if first else ends)
    off = F.col("number") - F.col("mean")
    histogram = inside.groupBy("c", "start", "ranks", bucket.alias("bucket")).agg(
        F.sum("n").alias("n"), F.min("number").alias("from"), F.max("number").alias("to"), F.sum(off * off * F.col("n")).alias("spread"),
        F.sum(off * F.col("n")).alias("drift"))
    whole = Window.partitionBy("c", "start")
    up_to_here = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    placed = histogram.withColumns({
        "end": F.col("start") + F.sum("n").over(up_to_here),
        "spread": F.sum("spread").over(whole), "drift": F.sum("drift").over(whole)})
    holds = F.exists("ranks", lambda r: (r >= F.col("end") - F.col("n")) & (r < F.col("end")))
    return placed.where(holds).select("c", (F.col("end") - F.col("n")).alias("start"), "end", "from", "to", "spread", "drift").collect()


def _quartiles(values: DataFrame, totals: dict) -> tuple[dict, dict, dict]:
    """Exact quartiles (between two numbers in proportion), means and standard deviations by column.

    Four rounds at most: a bucket of the first holds numbers of one sign that differ by a factor of
    1.0008 at most, which no more than 2 ** 42 doubles do; each further round cuts ranges into 2 ** 22
    parts. It ends when every bucket left holds one number; two rounds are usual.
    """
    numbers = values.where(F.col("number").isNotNull() & ~F.isnan("number"))
    ranks = {c: _ranks(t.counted) for c, t in totals.items() if t.counted}
    wanted = {c: sorted({r for low, high, _ in x.values() for r in (low, high)}) for c, x in ranks.items()}
    at: dict[tuple[int, int], float] = {}
    means: dict[int, float] = {}
    deviations: dict[int, float] = {}
    ranges = [(c, 0, totals[c].low, totals[c].high, totals[c].mean, wanted[c]) for c in ranks]
    first = True
    while ranges:
        found = _refined(numbers, ranges, first)
        if first:
            for r in found:
                # The first mean is off by what its sum was rounded by; so are the squares about it.
                n, mean = totals[r.c].counted, totals[r.c].mean
                means[r.c] = mean + r.drift / n
                if n > 1:
                    deviations[r.c] = math.sqrt(max(r.spread - r.drift * r.drift / n, 0.0) / (n - 1))
        ranges, first = [], False
        for r in found:
            here = [rank for rank in wanted[r.c] if r.start <= rank < r.end]
            if r["from"] == r.to:
                at.update({(r.c, rank): r.to for rank in here})
            else:
                ranges.append((r.c, r.start, r["from"], r.to, totals[r.c].mean, here))
    quartiles = {c: {name: at[c, low] + (at[c, high] - at[c, low]) * part for name, (low, high, part) in x.items()}
                 for c, x in ranks.items()}
    return quartiles, means, deviations


def _ends(values: DataFrame, by_number: dict[int, tuple], by_text: dict[int, tuple]) -> dict[int, dict[str, str]]:
    """Least and greatest value of each column as written, by number or by text. Only values at the ends
    (the least or greatest number, or first bytes) are compared as texts; two come back per column."""
    limits = [(c, *x, None, None) for c, x in by_number.items()] + [(c, None, None, *x) for c, x in by_text.items()]
    around = F.broadcast(_local(values.sparkSession, limits, "of int, low double, high double, first long, last long"))
    head = F.when(F.col("first").isNotNull(), _first_bytes(F.col("value")))
    is_end = {side: F.coalesce(F.col("number") == F.col(number), F.col("head") == F.col(text))
              for side, number, text in (("min", "low", "first"), ("max", "high", "last"))}
    rows = values.join(around, F.col("c") == F.col("of")).withColumn("head", head)
    sides = rows.withColumn("side", F.explode(F.array(*[F.when(at, F.lit(side)) for side, at in is_end.items()])))
    order = [F.when(F.col("side") == "min", F.col("value")), F.when(F.col("side") == "max", F.col("value")).desc()]
    place = F.row_number().over(Window.partitionBy("c", "side").orderBy(*order))
    found: dict[int, dict[str, str]] = {}
    for r in sides.where(F.col("side").isNotNull()).withColumn("place", place).where("place = 1").collect():
        found.setdefault(r.c, {})[r.side] = r.value
    return found


def _exact(df: DataFrame) -> DataFrame:
    """The table is read once; its counts are kept on the executors until the profile is done (what a
    lost executor held is counted again). What reaches the driver are some lines per column."""
    types = [kind for _, kind in df.dtypes]
    texts = [i for i, kind in enumerate(types) if kind == "string"]
    values = _values(df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        totals = {r.c: r for r in _totals(values, texts).collect()}
        quartiles, means, deviations = _quartiles(values, totals)
        found = {c: _fitting(types[c], t) for c, t in totals.items()}
        numeric = {c: (t.low, t.high) for c, t in totals.items() if t.counted and _is_number_type(found[c])}
        ends = _ends(values, numeric, {c: (t["first"], t.last) for c, t in totals.items() if t.non_null and c not in numeric})
    finally:
        values.unpersist()
    lines = []
    for c, (name, kind) in enumerate(df.dtypes):
        t, q, e = totals.get(c), quartiles.get(c, {}), ends.get(c, {})
        known = t.non_null if t else 0
        lines.append((
            name, t.n_rows if t else 0, found.get(c, kind), known, t.n_rows - known if t else 0, e.get("min"), e.get("max"),
            means.get(c), deviations.get(c), *(q.get(x) for x in QUARTILES), t.distinct if t else 0))
    quartile_fields = ", ".join(f"{name} double" for name in QUARTILES)
    return _local(
        df.sparkSession, lines, "column_name string, n_rows long, data_type string, non_null long, nulls long, min string, max string, "
               f"avg double, stddev double, {quartile_fields}, distinct long")


# ---- estimated -----------------------------------------------------------------------------


def _estimated(df: DataFrame, accuracy: int) -> DataFrame:
    """Everything in one aggregate without keys: distinct values and quartiles come from sketches, which
    tasks merge."""
    cells, stats = [], [F.count("*").alias("n_rows")]
    for i, (name, kind) in enumerate(df.dtypes):
        column = F.col(f"`{name}`")
        parsed = column.try_cast("double") if kind == "string" else column.cast("double") if _is_number_type(kind) else F.lit(None).cast("double")
        cells += [column.cast("string").alias(f"value_{i}"), null_if_nan(parsed).alias(f"number_{i}")]
        value, number = F.col(f"value_{i}"), F.col(f"number_{i}")
        by_number = F.when(number.isNotNull(), F.struct(number.alias("n"), value.alias("t")))
        if kind == "string":
            # Texts are parsed once, below the aggregate.
            cells += [column.try_cast("bigint").isNotNull().alias(f"whole_{i}"), parsed.isNotNull().alias(f"is_number_{i}"),
                      (parsed.isNull() & iso_date(column).isNotNull()).alias(f"is_date_{i}")]
            tests = {"bigint": f"whole_{i}", "double": f"is_number_{i}", "date": f"is_date_{i}"}
            found = F.coalesce(F.when(F.count(value) == 0, F.lit(kind)), *[
                F.when(F.count_if(test) == F.count(value), F.lit(name)) for name, test in tests.items()], F.lit(kind))
        else:
            found = F.lit(kind)
        numeric = found.isin("bigint", "double") if kind == "string" else F.lit(_is_number_type(kind))
        stats += [
            found.alias(f"data_type_{i}"),
            F.count(value).alias(f"non_null_{i}"),
            (F.count("*") - F.count(value)).alias(f"nulls_{i}"),
            F.when(numeric, F.min(by_number)["t"]).otherwise(F.min(value)).alias(f"min_{i}"),
            F.when(numeric, F.max(by_number)["t"]).otherwise(F.max(value)).alias(f"max_{i}"),
            F.avg(number).alias(f"avg_{i}"),
            F.stddev_samp(number).alias(f"stddev_{i}"),
            F.approx_count_distinct(value).alias(f"distinct_{i}"),
            *[F.percentile_approx(number, q, accuracy).alias(f"{name}_{i}") for name, q in QUARTILES.items()],
        ]
    lines = F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col("n_rows"), *[F.col(f"{stat}_{i}").alias(stat) for stat in _STATS])
        for i, name in enumerate(df.columns)
    ])
    return df.select(*cells).agg(*stats).select(F.inline(lines))


def profile_columns(df: DataFrame, exact: bool = False, accuracy: int = 10_000) -> DataFrame:
    """One row per column: type, rows, nulls, distinct values, range, mean, deviation and quartiles.

    Text gets the type that all its values fit; numbers in text are compared as numbers, NaN is none.
    By default distinct values (some 5 % off) and quartiles (the number at a rank at most 1 / accuracy of
    the rows off) are estimated in one pass. ``exact`` counts every distinct cell, which sends them all
    through one shuffle, and finds the quartiles from those counts.
    """
    return _exact(df) if exact else _estimated(df, accuracy)


def sample_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows in an order, to look at."""
    return df.orderBy(*order).limit(n)

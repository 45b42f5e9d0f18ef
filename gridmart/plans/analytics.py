"""Questions on race results. Each function takes a star and returns one DataFrame.

Common shape: narrow the fact, aggregate it by ids (partial sums before any shuffle), and
only then join names. "Most" keeps ties unless a top-n is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import date_key, decade_of
from ..functions.results import percentage, ratio
from ..operators.ranking import best_in_group, exact_median, with_previous
from ..schemas import DIM_DATE
from .star import Star


def _drivers(star: Star) -> DataFrame:
    return star.dim("dim_driver", "driver_id", "full_name")


def _constructors(star: Star) -> DataFrame:
    return star.dim("dim_constructor", "constructor_id", "name").withColumnRenamed("name", "constructor_name")


def _circuits(star: Star) -> DataFrame:
    return star.dim("dim_circuit", "circuit_id", "name").withColumnRenamed("name", "circuit_name")


def _wins_by(star: Star, group: str, who: str, period: Column | None = None) -> DataFrame:
    """Wins per (group, who); only winners appear."""
    source = "year" if period is not None else group
    # Keys are never NULL. Saying so here keeps both uses of the tallies the same plan, so
    # that Spark computes them once.
    wins = star.fact("is_win", source, who).where(F.col("is_win") & F.col(who).isNotNull() & F.col(source).isNotNull())
    if period is not None:
        wins = wins.withColumn(group, period)
    return wins.groupBy(group, who).agg(F.count("*").alias("wins"))


def champions(star: Star) -> DataFrame:
    """Drivers with the most championships.

    Champion of a year: most points, then most wins, then the lowest id.
    """
    seasons = star.fact("year", "driver_id", "points", "is_win").groupBy("year", "driver_id").agg(
        F.sum("points").alias("points"), F.count_if("is_win").alias("wins"))
    rank = F.struct("points", "wins", (-F.col("driver_id")).alias("id"))
    titles = (
        seasons.groupBy("year").agg(F.max_by("driver_id", rank).alias("driver_id"))
        .groupBy("driver_id").agg(F.count("*").alias("championships"))
    )
    return best_in_group(titles, [], "championships").join(_drivers(star), "driver_id")


def decade_dominance(star: Star) -> DataFrame:
    """Drivers with the most wins in each decade."""
    tallies = _wins_by(star, "decade", "driver_id", decade_of(F.col("year")))
    return best_in_group(tallies, ["decade"], "wins").join(_drivers(star), "driver_id")


def year_winners(star: Star) -> DataFrame:
    """Drivers with the most wins in each year."""
    return best_in_group(_wins_by(star, "year", "driver_id"), ["year"], "wins").join(_drivers(star), "driver_id")


def top_drivers(star: Star, n: int = 10) -> DataFrame:
    """The n drivers with the most wins, then points."""
    drivers = star.dim("dim_driver", "driver_id", "full_name", "nationality")
    totals = star.fact("driver_id", "points", "is_win", "is_podium").groupBy("driver_id").agg(
        F.count("*").alias("races"),
        F.count_if("is_win").alias("wins"),
        F.count_if("is_podium").alias("podiums"),
        F.sum("points").cast("double").alias("points"),
    )
    return totals.join(drivers, "driver_id").orderBy(F.desc("wins"), F.desc("points"), "driver_id").limit(n)


def _at_most(rows: DataFrame, n: int | None) -> DataFrame:
    return rows if n is None else rows.limit(n)


def top_poles(star: Star, n: int | None = None) -> DataFrame:
    """Drivers with a pole position, most first; only n of them if n is given."""
    poles = star.fact("driver_id", "is_pole").where("is_pole").groupBy("driver_id").agg(F.count("*").alias("poles"))
    return _at_most(poles.join(_drivers(star), "driver_id").orderBy(F.desc("poles"), "driver_id"), n)


def circuit_drivers(star: Star) -> DataFrame:
    """Drivers with the most wins on each circuit."""
    best = best_in_group(_wins_by(star, "circuit_id", "driver_id"), ["circuit_id"], "wins")
    return best.join(_drivers(star), "driver_id").join(_circuits(star), "circuit_id")


def pole_to_win_pct(star: Star) -> DataFrame:
    """Share of wins that started from pole; NULL without any win."""
    return star.fact("is_pole", "is_win").agg(
        F.round(percentage(F.count_if(F.col("is_pole") & F.col("is_win")), F.count_if("is_win")), 6)
        .alias("pole_to_win_pct"))


def pole_conversion(star: Star, min_poles: int = 1, n: int | None = None) -> DataFrame:
    """Drivers by the share of their poles that they turn into wins; only n of them if n is given."""
    poles = star.fact("driver_id", "is_pole", "is_win").where("is_pole").groupBy("driver_id").agg(
        F.count("*").alias("poles"), F.count_if("is_win").alias("wins_from_pole"))
    rated = poles.where(F.col("poles") >= min_poles).withColumn(
        "conversion", F.round(ratio(F.col("wins_from_pole"), F.col("poles")), 6))
    ordered = rated.join(_drivers(star), "driver_id").orderBy(F.desc("conversion"), F.desc("poles"), "driver_id")
    return _at_most(ordered, n)


def points_per_race(star: Star) -> DataFrame:
    """Points per race entered, for every constructor, best first."""
    # Points per (constructor, race) first: a hot constructor spreads over its races.
    per_race = star.fact("constructor_id", "race_id", "points").groupBy("constructor_id", "race_id").agg(
        F.sum("points").alias("points"))
    totals = per_race.groupBy("constructor_id").agg(
        F.count("*").alias("races"), F.sum("points").cast("double").alias("points"))
    rated = totals.withColumn("points_per_race", F.round(ratio(F.col("points"), F.col("races")), 6))
    return rated.join(_constructors(star), "constructor_id").orderBy(F.desc("points_per_race"), "constructor_id")


def one_two(star: Star) -> DataFrame:
    """Races in which a constructor took both first and second place, per constructor."""
    fronts = star.fact("race_id", "constructor_id", "finish_pos").where("finish_pos in (1, 2)")
    both = fronts.groupBy("race_id", "constructor_id").agg(
        F.bool_or(F.col("finish_pos") == 1).alias("first"),
        F.bool_or(F.col("finish_pos") == 2).alias("second"),
    ).where("first and second")
    counts = both.groupBy("constructor_id").agg(F.count("*").alias("one_twos"))
    return counts.join(_constructors(star), "constructor_id").orderBy(F.desc("one_twos"), "constructor_id")


def circuit_teams(star: Star) -> DataFrame:
    """Constructors with the most wins on each circuit."""
    best = best_in_group(_wins_by(star, "circuit_id", "constructor_id"), ["circuit_id"], "wins")
    return best.join(_constructors(star), "constructor_id").join(_circuits(star), "circuit_id")


def pit_trend(star: Star, pit_stops: DataFrame) -> DataFrame:
    """Pit-stop duration per year, and the change of the average from the previous year.

    ``pit_stops`` has race_id and duration_ms. One shuffle turns the stops into counts per
    (year, duration); count, average and exact median are all taken from those.
    """
    races = star.dim("dim_race", "race_id", "year")
    stops = pit_stops.where("duration_ms is not null").join(races, "race_id")
    counts = stops.groupBy("year", "duration_ms").agg(F.count("*").alias("n"))
    years = counts.groupBy("year").agg(
        F.sum("n").alias("stops"),
        ratio(F.sum(F.col("duration_ms") * F.col("n")), F.sum("n")).alias("avg_ms"),
    ).join(exact_median(counts, "year", "duration_ms", "n"), "year")
    # One row per year is left, so a window over all of them is small by construction.
    before = F.lag("avg_ms").over(Window.orderBy("year"))
    return years.select(
        "year", "stops", F.round("avg_ms", 6).alias("avg_ms"), F.col("median").alias("median_ms"),
        F.round(F.col("avg_ms") - before, 6).alias("change_ms"),
    )


_RACES_PER_BLOCK = 1 << 22


def season_form(star: Star, driver_id: int | None = None, year: int | None = None) -> DataFrame:
    """Start, finish and gain per race, with the change of finish from the previous race.

    For one driver and year, or for all of them. Races are ordered by date and id; season,
    round and date come with one join to the races.
    """
    if year is None:
        fact = star.fact("driver_id", "race_id", "grid_pos", "finish_pos")
    else:
        # Only the year's folders are read.
        fact = star.fact("driver_id", "race_id", "grid_pos", "finish_pos", "year").where(F.col("year") == year).drop("year")
    if driver_id is not None:
        fact = fact.where(F.col("driver_id") == driver_id)
    races = star.dim("dim_race", "race_id", "round", "date")
    races = races.select("race_id", "round", F.year("date").alias("year"), date_key(F.col("date")).alias("date_id"))
    fact = fact.join(races, "race_id")
    # Days, and blocks of race ids within a day, keep the windows of a busy season small.
    blocks = fact.withColumn("_block", F.floor(F.col("race_id") / _RACES_PER_BLOCK))
    form = with_previous(blocks, ["driver_id", "year"], ["date_id", "_block"], "race_id", "finish_pos", "_previous")
    return form.select(
        "driver_id", "year", "round", "date_id", "race_id", "grid_pos", "finish_pos",
        F.try_subtract(F.col("grid_pos"), F.col("finish_pos")).alias("gain"),
        F.try_subtract(F.col("finish_pos"), F.col("_previous")).alias("finish_change"),
    )


def outside_top_k(star: Star, k: int = 10) -> DataFrame:
    """Wins that started behind place k; a start from the pit lane (grid 0) is not counted."""
    return star.fact("is_win", "grid_pos").agg(
        F.count_if(F.col("is_win") & (F.col("grid_pos") > k)).alias("wins_outside_top_k"))


def driver_by_year(star: Star, full_name: str | None = None, collation: str | None = None,
                   when: Column | None = None) -> DataFrame:
    """Races, points, wins and average finish per year, for one driver name or for all.

    Names compare exactly; pass a collation such as UNICODE_CI_AI to ignore case and accents. ``when`` is
    a condition on the columns of the date dimension. Dates are then joined by year too, which the date
    implies: the fact lies in folders by year, and Spark reads those of the dates found only.
    """
    drivers = _drivers(star)
    day = ["date_id"] if when is None else ["date_id", "year"]
    rows = star.fact("driver_id", *day, "points", "is_win", "finish_pos")
    if full_name is not None:
        name = F.collate("full_name", collation) if collation else F.col("full_name")
        drivers = drivers.where(name == full_name)
        rows = rows.join(drivers.select("driver_id"), "driver_id", "left_semi")
    # Per (driver, date) first, so that no join meets all rows of a busy driver.
    days = rows.groupBy("driver_id", *day).agg(
        F.count("*").alias("races"),
        F.sum("points").alias("points"),
        F.count_if("is_win").alias("wins"),
        F.sum("finish_pos").alias("places"),
        F.count("finish_pos").alias("classified"),
    )
    dates = star.dim("dim_date", *(("date_id", "year") if when is None else DIM_DATE.columns))
    dates = (dates.where(when) if when is not None else dates).select("date_id", "year")
    years = days.join(dates, day).groupBy("year", "driver_id").agg(
        F.sum("races").alias("races"),
        F.sum("points").cast("double").alias("points"),
        F.sum("wins").alias("wins"),
        F.round(ratio(F.sum("places"), F.sum("classified")), 6).alias("avg_finish"),
    )
    return years.join(drivers, "driver_id").orderBy("year", "driver_id")

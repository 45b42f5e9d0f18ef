import random
import re
import statistics

import numpy as np
import pytest

from pyspark.sql import functions as F

from gridmart.operators.keys import first_rows, mark_first, repeated_keys
from gridmart.operators.lookups import mark_parent, orphan_counts
from gridmart.operators.profile import _totals, _values, profile_columns, sample_rows
from gridmart.operators.ranking import best_in_group, exact_median, with_previous


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_first_rows_drops_duplicates_before_the_shuffle(spark):
    """A key with a third of the rows leaves one row per task."""
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), (-F.col("id")).alias("o"))
    firsts = first_rows(rows, ["k"], ["o"])
    plan = plan_of(firsts)
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(k") < plan.index("Partial")
    assert firsts.count() == 6001
    assert firsts.where("k = -1").first().o == -8997


def test_mark_first_marks_the_first_candidate_of_each_key(spark):
    rng = random.Random(5)
    data = [(rng.choice([1, 1, 1, 2, 3]), i, rng.random() < 0.5) for i in range(300)] + [(9, 300, True)]
    rows = spark.createDataFrame(data, "k int, o int, good boolean")
    marked = mark_first(rows, rows.where("good").select("k", "o"), ["k"], "o", "is_first").where("good").collect()
    expected = {k: min(o for kk, o, g in data if kk == k and g) for k in (1, 2, 3, 9)}
    assert {r.k: r.o for r in marked if r.is_first} == expected
    assert sum(r.is_first for r in marked) == 4 and len(marked) == sum(g for _, _, g in data)


def test_repeated_keys_are_counted_inside_the_tasks(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    repeated = repeated_keys(rows, ["k"], "o", "first")
    plan = plan_of(repeated)
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(k")
    assert [tuple(r) for r in repeated.collect()] == [(-1, 0)]


def test_mark_parent_and_orphan_counts(spark):
    child = spark.createDataFrame([(1, 1), (1, 9), (2, 9), (None, 1)], "a int, b int")
    parents = {"pa": spark.createDataFrame([(1,)], "x int"), "pb": spark.createDataFrame([(1,), (9,)], "y int")}
    marked = mark_parent(child, parents["pa"], "a", "known").collect()
    assert sorted((r.a or 0, r.known) for r in marked) == [(0, False), (1, True), (1, True), (2, False)]
    counts = orphan_counts(child, [("a", "pa"), ("b", "pb")], parents).collect()
    assert {r.check: r.orphans for r in counts} == {"pa": 2, "pb": 0}
    none = orphan_counts(child.limit(0), [("a", "pa"), ("b", "pb")], parents).collect()
    assert {r.check: r.orphans for r in none} == {"pa": 0, "pb": 0}


def test_mark_parent_by_a_condition(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    assert [r.known for r in mark_parent(rows, F.col("a") > 1, "a", "known").collect()] == [False, True, False]


def test_best_in_group_keeps_ties(spark):
    rows = spark.createDataFrame([(1, "a", 3), (1, "b", 3), (1, "c", 2), (2, "a", 1)], "g int, who string, n int")
    assert sorted(map(tuple, best_in_group(rows, ["g"], "n").select("g", "who").collect())) == [
        (1, "a"), (1, "b"), (2, "a")]
    assert sorted(r.who for r in best_in_group(rows, [], "n").collect()) == ["a", "b"]


def test_with_previous_equals_a_plain_lag(spark):
    """Against brute force, with one group holding a third of the rows and NULL values."""
    rng = random.Random(11)
    data = {}
    for _ in range(900):
        group = rng.choice([0, 1, 2, 3, 4, 4, 4])
        day, row = rng.randrange(6), rng.randrange(400)
        data[group, day, row] = rng.choice([None, 1, 2, 3])
    rows = spark.createDataFrame(
        [(g, d, r // 50, r, v) for (g, d, r), v in data.items()], "g int, d int, b int, r int, v int")
    got = {(x.g, x.d, x.r): x.p for x in with_previous(rows, ["g"], ["d", "b"], "r", "v", "p").collect()}
    expected = {}
    for g in range(5):
        keys = sorted(k for k in data if k[0] == g)
        for before, key in zip([None, *keys], keys):
            expected[key] = data[before] if before else None
    assert got == expected


def test_exact_median_equals_brute_force(spark):
    rng = random.Random(3)
    data = {g: [rng.choice([7, 999, 1000, 1001, rng.randrange(100_000)]) for _ in range(n)]
            for g, n in ((1, 1), (2, 2), (3, 101), (4, 500))}
    data[5] = [400, 5400]  # the two middle values lie in different buckets
    rows = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g int, v bigint")
    counts = rows.groupBy("g", "v").agg(F.count("*").alias("n"))
    got = {r.g: r["median"] for r in exact_median(counts, "g", "v", "n").collect()}
    assert got == {g: float(statistics.median(vs)) for g, vs in data.items()}


def test_profile(spark):
    rows = spark.createDataFrame(
        [("a", 1, "9", "1.5", "2020-02-03", 1.0), ("b", 2, "10", "12", "2019-12-31", float("nan")), (None, 2, None, "-3", None, 3.0)],
        "s string, n int, whole string, part string, day string, x double")
    profile = {r.column_name: r for r in profile_columns(rows, exact=True).collect()}
    estimated = {r.column_name: r for r in profile_columns(rows).collect()}
    for name, r in profile.items():
        same = [k for k in r.asDict() if k not in ("q25", "q50", "q75", "stddev")]
        assert [r[k] for k in same] == [estimated[name][k] for k in same]
        assert r.stddev == pytest.approx(estimated[name].stddev)
    s, n = profile["s"], profile["n"]
    assert (s.data_type, s.n_rows, s.non_null, s.nulls, s.distinct, s["min"], s["max"], s.avg) == ("string", 3, 2, 1, 2, "a", "b", None)
    assert (n.data_type, n.nulls, n.distinct, n["min"], n["max"]) == ("int", 0, 2, "1", "2")
    assert abs(n.avg - 5 / 3) < 1e-9 and abs(n.stddev - 0.57735) < 1e-4
    found = {name: (profile[name].data_type, profile[name]["min"], profile[name]["max"]) for name in ("whole", "part", "day")}
    assert found == {"whole": ("bigint", "9", "10"), "part": ("double", "-3", "12"), "day": ("date", "2019-12-31", "2020-02-03")}
    assert profile["x"].avg == 2.0  # a NaN does not spoil the mean
    assert [r.s for r in sample_rows(rows, 2, F.col("s").desc_nulls_last()).collect()] == ["b", "a"]


def _drawn_numbers(seed):
    draw = random.Random(seed)
    return {
        "near": [1e15 + draw.randint(0, 9) for _ in range(500)],
        "wide": [draw.choice((-1, 1)) * 10.0 ** draw.uniform(-300, 300) for _ in range(700)] + [0.0] * 5,
        "tiny": [draw.choice((5e-324, 1e-323, 2.5e-308, 0.0, -5e-324)) for _ in range(301)],
        "next": [1.0 + k * 2.0 ** -52 for k in draw.sample(range(4096), 400)],
        "same": [7.0] * 101, "few": [draw.randint(0, 3) for _ in range(50)], "one": [3.5], "two": [1.0, 2.0],
        "hot": [5.0] * 900 + [draw.random() for _ in range(600)],
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_quartiles_are_exact(spark, seed):
    """Against numpy, on numbers that lie close together, far apart, or mostly on one value."""
    columns = _drawn_numbers(seed)
    length = max(map(len, columns.values()))
    rows = [tuple(repr(float(x[i])) if i < len(x) else None for x in columns.values()) for i in range(length)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).repartition(5)
    profile = {r.column_name: r for r in profile_columns(df, exact=True).collect()}
    estimated = {r.column_name: r for r in profile_columns(df).collect()}
    for name, numbers in columns.items():
        got = profile[name]
        assert [got.q25, got.q50, got.q75] == pytest.approx(list(np.quantile(numbers, [0.25, 0.5, 0.75])), rel=1e-15), name
        assert got.non_null == len(numbers) and got.distinct == len(set(map(float, numbers)))
        assert (float(got["min"]), float(got["max"])) == (min(numbers), max(numbers))
        if len(numbers) > 1 and name != "wide":
            assert got.stddev == pytest.approx(statistics.stdev(numbers), rel=1e-9, abs=1e-300)
        # A sketch gives one of the numbers, near the rank.
        assert estimated[name].q50 in numbers
    assert profile["one"].stddev is None


def test_profile_of_nothing_and_of_texts(spark):
    texts = ["b", "a\0", "a", "abcdefgh", "abcdefgz", "\u00e9", "", "zzzzzzzz1", "zzzzzzzz0", None]
    df = spark.createDataFrame([(t, None, True) for t in texts], "t string, none double, flag boolean")
    profile = {r.column_name: r for r in profile_columns(df, exact=True).collect()}
    assert (profile["t"]["min"], profile["t"]["max"], profile["t"].distinct, profile["t"].q50) == ("", "\u00e9", 9, None)
    assert (profile["none"].data_type, profile["none"].nulls, profile["none"]["min"]) == ("double", 10, None)
    assert (profile["flag"]["max"], profile["flag"].data_type) == ("true", "boolean")
    upper = profile_columns(df.where("t like 'zzz%' or t like 'abc%'"), exact=True).where("column_name = 't'").first()
    assert (upper["min"], upper["max"]) == ("abcdefgh", "zzzzzzzz1")
    empty = profile_columns(df.limit(0), exact=True).collect()
    assert [(r.column_name, r.data_type, r.n_rows, r.distinct, r.q25) for r in empty] == [
        ("t", "string", 0, 0, None), ("none", "double", 0, 0, None), ("flag", "boolean", 0, 0, None)]


def test_exact_profile_sorts_no_rows(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as a", "id % 7 as b")
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(_totals(_values(df), [0])._jdf.queryExecution(), "formatted")
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan

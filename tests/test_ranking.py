import dataclasses
import random

import pytest

from sectorgauge.operators import ranking

SCHEMA = "division string, g string, value double"


def population(kind, n=600, seed=1):
    rng = random.Random(seed)
    draw = {
        "spread": lambda: rng.gauss(0, 100),
        "ties": lambda: float(rng.randrange(4)),
        "mostly one value": lambda: 0.0 if rng.random() < 0.7 else rng.gauss(0, 1),
        "with nulls": lambda: None if rng.random() < 0.4 else rng.gauss(0, 1),
        "all null": lambda: None,
        "constant": lambda: 5.0,
    }[kind]
    # one group holds most rows, others are small or single
    return [
        (str(i), "hot" if i % 3 else f"g{i % 30}", draw()) for i in range(n)
    ] + [("solo", "alone", draw())]


@pytest.mark.parametrize(
    "kind", ["spread", "ties", "mostly one value", "with nulls", "all null", "constant"]
)
def test_slices_give_the_same_ranks_as_one_window(spark, rows, settings, kind):
    df = spark.createDataFrame(population(kind), SCHEMA)
    sliced = dataclasses.replace(settings, hot_group_rows=15, rank_slices=8)
    columns = ["division", "g", "group_rows", "percentile", "q1", "q3"]
    whole = ranking.rank_in_groups(df, ["g"], "value", "division", settings)
    cut = ranking.rank_in_groups(df, ["g"], "value", "division", sliced)
    assert rows(cut, *columns) == rows(whole, *columns)
    assert cut.count() == df.count()


def test_percentile_by_hand(table, rows, settings):
    df = table(SCHEMA, *[(str(i), "g", float(v)) for i, v in enumerate([1, 2, 2, 3, 10])])
    got = rows(
        ranking.rank_in_groups(df, ["g"], "value", "division", settings),
        "value", "percentile", "q1", "q3",
    )
    assert got == [
        (1.0, 0.0, 1.0, 10.0),
        (10.0, 1.0, 1.0, 10.0),
        (2.0, 0.25, 1.0, 10.0),
        (2.0, 0.25, 1.0, 10.0),
        (3.0, 0.75, 1.0, 10.0),
    ]


def test_hot_slices_spread_a_single_value_over_tasks(spark, settings):
    """Rows that share one value must not share one window partition."""
    df = spark.createDataFrame(population("constant"), SCHEMA)
    sliced = dataclasses.replace(settings, hot_group_rows=15, rank_slices=8)
    plan = ranking.rank_in_groups(df, ["g"], "value", "division", sliced)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(division" in text


def test_ordinary_groups_need_one_shuffle_and_one_sort(spark, settings):
    df = spark.createDataFrame(population("spread"), SCHEMA)
    plan = ranking.rank_in_groups(df, ["g"], "value", "division", settings)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1

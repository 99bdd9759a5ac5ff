import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sectorgauge.operators import selection
from sectorgauge.operators.selection import exact_percentile


def by_sort(rows, share):
    groups = defaultdict(list)
    for key, value in rows:
        groups[key].append(value)
    result = {}
    for key, values in groups.items():
        known = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
        place = max(math.ceil(round(share * len(known), 9)), 1) - 1
        result[key] = (known[place] if known else None, len(known))
    return result


def picked(df, keys=("k",)):
    return {
        tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: (r["v"], r["population"])
        for r in df.collect()
    }


ROWS = (
    [("even", float(x)) for x in (4, 1, 3, 2)]
    + [("one", 7.5)]
    + [("ties", x) for x in (5.0, 5.0, 5.0, 1.0, 9.0, None)]
    + [("none", None), ("none", None)]
    + [(None, -1.0), (None, -2.0), (None, -3.0)]
    + [("wide", (x * 7919 % 10007) / 3) for x in range(10007)]
)


@pytest.mark.parametrize("share", [0.07, 0.25, 0.5, 0.9, 1.0])
def test_equals_a_sort(table, share):
    df = table("k string, v double", *ROWS)
    assert picked(exact_percentile(df, ["k"], "v", share)) == by_sort(ROWS, share)


def test_poor_cuts_change_nothing(table, monkeypatch):
    """With the coarsest sketch the rank falls outside the cuts, and is still found."""
    monkeypatch.setattr(selection, "ACCURACY", 1)
    monkeypatch.setattr(selection, "MARGIN", 0.0)
    monkeypatch.setattr(selection, "BROADCAST_GROUPS", 0)
    df = table("k string, v double", *ROWS)
    for share in (0.3, 0.5, 0.8):
        assert picked(exact_percentile(df, ["k"], "v", share)) == by_sort(ROWS, share)


def test_nan_is_above_all_numbers_and_names_may_clash(table):
    df = table("cuts string, slice double", ("a", 1.0), ("a", math.nan), ("a", 2.0))
    got = exact_percentile(df, ["cuts"], "slice").collect()
    assert [tuple(r) for r in got] == [("a", 2.0, 3)]
    assert exact_percentile(df.limit(0), ["cuts"], "slice").count() == 0


def test_a_share_outside_is_refused(table):
    with pytest.raises(ValueError):
        exact_percentile(table("k string, v double", ("a", 1.0)), ["k"], "v", 0.0)


def test_a_large_cell_is_cut_before_it_is_ordered(spark):
    """Five million rows in one cell: the result of a sort, from a slice of it."""
    n = 5_000_000
    df = spark.range(n, numPartitions=8).select(
        F.lit("a").alias("k"), ((F.col("id") * 2654435761) % 5_000_011).alias("v")
    )
    want = sorted(x * 2654435761 % 5_000_011 for x in range(n))[(n + 1) // 2 - 1]
    assert picked(exact_percentile(df, ["k"], "v")) == {"a": (want, n)}

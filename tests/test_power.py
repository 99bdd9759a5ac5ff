import numpy as np
import pytest

from pyspark.sql import functions as F
from sectorgauge.functions.columns import yeo_johnson
from sectorgauge.operators import power


def transform(x, lam):
    out = np.empty_like(x)
    up = x >= 0
    out[up] = np.log1p(x[up]) if lam == 0 else ((x[up] + 1) ** lam - 1) / lam
    down = ~up
    out[down] = (
        -np.log1p(-x[down]) if lam == 2 else -((1 - x[down]) ** (2 - lam) - 1) / (2 - lam)
    )
    return out


def likelihood(x, lam):
    """By the definition, in extended range: plain doubles overflow at large exponents."""
    x, lam = x.astype(np.longdouble), np.longdouble(lam)
    side = 1 if (x >= 0).all() else -1 if (x < 0).all() else 0
    power = lam if side > 0 else 2 - lam
    if side and power != 0:
        # One side only: the constant adds no variance, but would take all digits.
        t = (1 + np.abs(x)) ** power / power
    else:
        t = transform(x, lam)
    with np.errstate(divide="ignore"):
        spread = np.log(t.var())
    return float(
        -len(x) / 2 * spread + (lam - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))
    )


@pytest.mark.parametrize("lam", [-2.0, -0.5, 0.0, 1e-13, 0.3, 1.0, 2.0])
def test_transform_matches_its_definition(spark, lam):
    x = np.array([-30.0, -1.0, -0.2, 0.0, 0.4, 2.0, 55.0])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = [r[0] for r in df.select(yeo_johnson(F.col("x"), F.lit(lam))).collect()]
    want = transform(x, 0.0 if abs(lam) < 1e-9 else lam)
    assert got == pytest.approx(list(want), rel=1e-9, abs=1e-9)


def test_exponent_maximises_the_likelihood(spark, settings):
    rng = np.random.default_rng(5)
    groups = {
        "skewed": rng.gamma(2.0, 10.0, 400),
        "mixed": rng.normal(3, 4, 400),
        "left": 60 - rng.gamma(2.0, 6.0, 400),
        "small": np.array([3.0, 9.0, 20.0, 21.0]),
        "ceiling": 60 - rng.gamma(0.3, 4.0, 400).clip(0, 50),
        "large": 1e6 - rng.gamma(2.0, 1e5, 400),
        "floor": rng.gamma(0.3, 0.2, 400),
        "below": -60 + rng.gamma(0.3, 4.0, 400).clip(0, 50),
    }
    rows = [(g, str(i), float(v)) for g, x in groups.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "g string, division string, value double")
    found = power.yeo_johnson_lambda(df, ["g"], "value", settings).collect()
    assert {r.g for r in found} == groups.keys()
    whole = np.arange(-64, 64.00001, 0.05)
    for row in found:
        x = groups[row["g"]]
        best = whole[np.nanargmax([likelihood(x, lam) for lam in whole])]
        fine = best + np.arange(-0.1, 0.1, 0.002)
        best = fine[np.nanargmax([likelihood(x, lam) for lam in fine])]
        assert row["length"] == len(x)
        assert row["lambda"] == pytest.approx(best, abs=0.005), row["g"]


def test_exponent_stays_where_the_transform_is_finite(spark, settings):
    """The likelihood of values piled up below a high ceiling rises past the last exponent."""
    rows = [("g", 1e6 - (i == 0)) for i in range(300)] + [("low", 1e-9 * i**9) for i in range(9)]
    df = spark.createDataFrame(rows, "g string, value double")
    moved = power.yeo_johnson_transform(df, ["g"], "value", settings).collect()
    exponent = {r.g: r["lambda"] for r in moved}["g"]
    assert 43 < exponent <= power.GROWTH_LIMIT / np.log(1e6)
    assert all(np.isfinite(r.value_t) for r in moved)


def test_plan_has_no_partition_count_and_no_broadcast_hint(spark, settings):
    df = spark.createDataFrame([("g", 1.0)], "g string, value double")
    found = power.yeo_johnson_lambda(df, ["g"], "value", settings)
    text = found._jdf.queryExecution().toString()
    assert "REPARTITION_BY_NUM" not in text and "strategy=broadcast" not in text


def test_constant_and_single_groups_stay_as_they_are(table, rows, settings):
    schema = "g string, division string, value double"
    df = table(schema, *[("c", d, 5.0) for d in "abc"], ("s", "d", 7.0))
    moved = power.yeo_johnson_transform(df, ["g"], "value", settings)
    assert rows(moved, "g", "lambda", "length") == [("c", 1.0, 3.0)] * 3 + [("s", 1.0, 1.0)]
    values = [r[0] for r in rows(moved, "value_t")]
    assert values == pytest.approx([5.0, 5.0, 5.0, 7.0])


def _extents_of(spark, groups, settings):
    rows = [(g, float(v)) for g, x in groups.items() for v in x]
    values = power._collapsed(spark.createDataFrame(rows, "g string, value double"), ["g"], "value")
    return values, power._extents(values, ["g"]).withColumn("n", F.col("n").cast("double"))


def test_only_groups_at_an_edge_enter_the_next_pass(spark, settings):
    rng = np.random.default_rng(8)
    groups = {
        "near": rng.gamma(2.0, 10.0, 300),
        "normal": rng.normal(3, 4, 300),
        "ceiling": 60 - rng.gamma(0.3, 4.0, 300).clip(0, 50),
        "floor": rng.gamma(0.3, 0.2, 300),
        "far": 1e3 - rng.gamma(0.3, 0.5, 300),
    }
    passes = power.bracketed(*_extents_of(spark, groups, settings), ["g"], settings)
    found = [{r["g"]: (r["best"], r["step"]) for r in p.collect()} for p in passes]
    assert set(found[0]) >= {"near", "normal"} and "far" not in found[0]
    assert sorted(g for p in found for g in p) == sorted(groups)  # each group settles once
    assert all(step in (10 * 2**k, 20 * 2**k) for k, p in enumerate(found) for _, step in p.values())


def test_exponents_from_end_to_end_of_the_range(spark, settings):
    """Groups made by undoing the transform of a sample, for exponents all over the range."""
    rng = np.random.default_rng(9)
    groups = {}
    for lam in (-60, -31.3, -14.2, -5.1, -1.9, 0.0, 2.0, 3.9, 4.1, 9.7, 17, 38.5, 60):
        z = rng.normal(0, 1, 200)
        z = (z - z.min()) / (z.max() - z.min())  # 0 to 1
        power_of = np.exp(lam * 0.05) if lam else None  # sizes up to 0.05
        t = z * (power_of - 1) + 1 if lam else z * 0.05
        groups[str(lam)] = np.expm1(np.log(t) / lam if lam else t)
    rows = [(g, float(v)) for g, x in groups.items() for v in x]
    df = spark.createDataFrame(rows, "g string, value double")
    whole = np.arange(-64, 64.00001, 0.05)
    for row in power.yeo_johnson_lambda(df, ["g"], "value", settings).collect():
        x = groups[row["g"]]
        scores = [likelihood(x, lam) for lam in whole]
        assert abs(row["lambda"] - whole[np.nanargmax(scores)]) < 0.051, row["g"]


def test_repeated_values_weigh_as_often_as_they_occur(spark, settings):
    rng = np.random.default_rng(10)
    x = np.round(rng.gamma(2.0, 6.0, 500))  # whole days
    once = power.yeo_johnson_lambda(spark.createDataFrame([("g", float(v)) for v in x], "g string, value double"), ["g"], "value", settings).first()
    whole = np.arange(-3, 3, 0.01)
    best = whole[np.argmax([likelihood(x, lam) for lam in whole])]
    assert once["length"] == 500 and once["lambda"] == pytest.approx(best, abs=0.011)

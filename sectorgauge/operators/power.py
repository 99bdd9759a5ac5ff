"""Yeo-Johnson transform with a likelihood-chosen exponent per group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.config import Settings
from sectorgauge.functions.columns import yeo_johnson
from sectorgauge.sources.stages import stage

#: First bracket of exponents, in units; its points are half a unit apart.
BRACKET = (-2, 4)
#: Points by which a bracket grows beyond its edge, each time at twice the distance.
GROWN = 12
#: Brackets of up to so many half units are searched at all their points at once.
NEAR = 4
#: Exponents whose transform would exceed e to this power are not taken.
GROWTH_LIMIT = 600.0


def _collapsed(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Each group's distinct values as side, log size and number of rows."""
    x = F.col(value)
    counted = df.filter(x.isNotNull()).groupBy(*keys, x.alias("x")).agg(F.count("*").alias("rows"))
    return counted.select(
        *keys, (F.col("x") >= 0).alias("rises"), F.log1p(F.abs("x")).alias("size"), "rows"
    )


def _extents(values: DataFrame, keys: list[str]) -> DataFrame:
    """Per group: rows, ends of both sides, and the sum of signed log sizes."""
    size, rises = F.col("size"), F.col("rises")
    signed = F.when(rises, size).otherwise(-size)
    ends = {
        "up_low": F.min(F.when(rises, size)),
        "up_high": F.max(F.when(rises, size)),
        "down_low": F.min(F.when(~rises, size)),
        "down_high": F.max(F.when(~rises, size)),
    }
    return values.groupBy(*keys).agg(
        F.sum("rows").alias("n"),
        F.min(signed).alias("lowest"),
        F.max(signed).alias("highest"),
        F.sum(signed * F.col("rows")).alias("log_jacobian"),
        *(end.alias(name) for name, end in ends.items()),
    )


def _scale(up: Column) -> Column:
    """Log of a group's largest power at exponent ``up``; the constants count as power 0."""
    down = 2 - up
    return F.greatest(
        up * F.when(up > 0, F.col("up_high")).otherwise(F.col("up_low")),
        down * F.when(down > 0, F.col("down_high")).otherwise(F.col("down_low")),
        F.when(F.col("up_high").isNotNull() & F.col("down_high").isNotNull(), F.lit(0.0)),
    )


def _allowed(grids: Column, settings: Settings) -> Column:
    """The grid points within the range and the growth limit."""
    per_unit = float(settings.lambda_steps_per_unit)
    last = settings.lambda_limit * per_unit
    return F.filter(grids, lambda g: (F.abs(g) <= last) & (_scale(g / per_unit) <= GROWTH_LIMIT))


def _terms(groups: DataFrame, keys: list[str], settings: Settings) -> DataFrame:
    """The transform as ``a * exp(p * size - scale) + b * size + c`` per group, point and side.

    Powers are divided by the group's largest one. Constants are left out where they
    shift all rows alike: the constant of the side whose power is below zero moves to
    the other side, and the transform of the group's mean log size is taken off, so
    neither large nor small exponents lose their digits.
    """
    up, down, one, between = F.col("up"), F.col("down"), F.col("one"), F.col("between")
    flat_up, flat_down, zero = up == 0, down == 0, F.lit(0.0)
    middle, mean, scale = F.col("middle"), F.col("log_jacobian") / F.col("n"), F.col("scale")
    marks = (
        groups.withColumn("grid", F.explode("points"))
        .withColumn("up", F.col("grid") / float(settings.lambda_steps_per_unit))
        .withColumns({"down": 2 - up, "scale": _scale(up), "middle": F.abs(mean)})
        .withColumn("one", F.exp(-scale))
        .withColumn("between", F.try_divide(2 * one, up * down))
        .withColumns(
            {
                "up_a": F.when(flat_up, zero).otherwise(1 / up),
                "up_b": F.when(flat_up, one).otherwise(zero),
                "up_c": F.when(flat_down, -one / up).when(~flat_up & (up > 1), -between).otherwise(zero),
                "down_a": F.when(flat_down, zero).otherwise(-1 / down),
                "down_b": F.when(flat_down, -one).otherwise(zero),
                "down_c": F.when(flat_up, one / down).when(~flat_down & (up <= 1), between).otherwise(zero),
            }
        )
        .withColumn(
            "shift",
            F.when(mean >= 0, F.col("up_a") * F.exp(up * middle - scale) + F.col("up_b") * middle + F.col("up_c"))
            .otherwise(F.col("down_a") * F.exp(down * middle - scale) + F.col("down_b") * middle + F.col("down_c")),
        )
    )

    def side(name: str, rises: bool) -> Column:
        a, b, c = (F.col(f"{name}_{x}") for x in "abc")
        return F.struct(
            F.lit(rises).alias("rises"), F.col(name).alias("p"), a.alias("a"), b.alias("b"), (c - F.col("shift")).alias("c")
        )

    both = F.explode(F.array(side("up", True), side("down", False))).alias("side")
    return marks.select(*keys, "log_jacobian", "grid", "scale", both).select(*keys, "log_jacobian", "grid", "scale", "side.*")


def _score(values: DataFrame, groups: DataFrame, keys: list[str], settings: Settings) -> DataFrame:
    """Log-likelihood of each group of ``groups`` at its ``points``, as (keys, grid, llf).

    All that depends on group and exponent alone is computed once per group; a row
    costs one power. Rows are combined before the shuffle.
    """
    # No hint: two rows per group and point, small or not.
    dealt = values.join(_terms(groups, keys, settings), [*keys, "rises"])
    size = F.col("size")
    moved = F.col("a") * F.exp(F.col("p") * size - F.col("scale")) + F.col("b") * size + F.col("c")
    sums = (
        dealt.select(*keys, "log_jacobian", "rows", "grid", "scale", moved.alias("moved"))
        .groupBy(*keys, "grid")
        .agg(
            F.sum("rows").alias("n"),
            F.sum(F.col("rows") * F.col("moved")).alias("s1"),
            F.sum(F.col("rows") * F.col("moved") * F.col("moved")).alias("s2"),
            F.max("scale").alias("scale"),
            F.max("log_jacobian").alias("log_jacobian"),
        )
    )
    mean, n = F.col("s1") / F.col("n"), F.col("n")
    lam = F.col("grid") / float(settings.lambda_steps_per_unit)
    return (
        sums.withColumn("variance", F.col("s2") / n - mean * mean)
        .filter(F.col("variance") > 0)
        .select(
            *keys,
            "grid",
            (
                -n / 2 * (F.log("variance") + 2 * F.col("scale"))
                + (lam - 1) * F.col("log_jacobian")
            ).alias("llf"),
        )
    )


def _placed(scored: DataFrame, groups: DataFrame, keys: list[str], settings: Settings) -> DataFrame:
    """``groups`` with the best grid point, and the points of a wider bracket if it is open.

    A bracket is open where its best point is its first or last and further exponents
    are allowed at twice the distance. ``points`` is empty for closed ones. The top lies
    within ``step`` of ``best``: twice the distance where the range ends behind it.
    """
    best = scored.groupBy(*keys).agg(
        F.max_by("grid", F.struct("llf", -F.col("grid"))).alias("best"),
        F.min("grid").alias("first"),
        F.max("grid").alias("last"),
    )
    centre, wide = F.col("best"), 2 * F.col("step")
    above = F.sequence(centre - wide, centre + GROWN * wide, wide)
    below = F.sequence(centre - GROWN * wide, centre + wide, wide)
    tried = F.when(centre == F.col("last"), above).when(centre == F.col("first"), below)
    allowed = _allowed(F.coalesce(tried, F.array().cast("array<int>")), settings)
    beyond = F.when(
        F.exists(allowed, lambda g: F.when(centre == F.col("last"), g > centre).otherwise(g < centre)),
        allowed,
    )
    return (
        groups.drop("points").join(best, keys)
        .withColumn("points", F.coalesce(beyond, F.array().cast("array<int>")))
        .withColumn("step", F.when(F.col("best").isin(F.col("first"), F.col("last")), wide).otherwise(F.col("step")))
        .drop("first", "last")
    )


def bracketed(
    values: DataFrame, groups: DataFrame, keys: list[str], settings: Settings
) -> list[DataFrame]:
    """Stored ``best`` point and ``step`` of each group, a table per search pass.

    The first pass covers all groups. Only groups whose best point lies on the edge of
    their bracket enter the next one, at twice the distance and ``GROWN`` points further.
    The top of a group lies within ``step`` of ``best``.
    """
    half = max(1, settings.lambda_steps_per_unit // 2)
    ends = (e * settings.lambda_steps_per_unit for e in BRACKET)
    grid = F.array(*(F.lit(g) for g in range(next(ends), next(ends) + 1, half)))
    tried = groups.withColumn("step", F.lit(half)).withColumn("points", _allowed(grid, settings))
    passes = []
    while True:
        scored = _score(values, tried, keys, settings)
        found = stage(_placed(scored, tried, keys, settings), "bracket")
        passes.append(found.filter(F.size("points") == 0))
        if not found.agg(F.coalesce(F.max(F.size("points")), F.lit(0))).first()[0]:
            return passes
        tried = found.filter(F.size("points") > 0).drop("best")


def yeo_johnson_lambda(
    df: DataFrame, keys: list[str], value: str, settings: Settings
) -> DataFrame:
    """Maximum-likelihood exponent per group, as (keys, lambda, length).

    The profile log-likelihood is a plain aggregate and has one top. A bracket of
    exponents is widened only for the groups that need it, up to ``Settings.lambda_limit``,
    and refined for all at once; a parabola through the best point and its neighbours
    gives the exponent between grid points. Equal values are collapsed first, and each
    pass combines its rows before the shuffle: a group of any size leaves a task as one
    row per exponent. Groups with one distinct value get 1; groups whose likelihood
    still rises at the end of the range, or where the transform would exceed
    ``GROWTH_LIMIT``, get the last exponent before it. ``keys`` must not be NULL.

    The collapsed values and one row per group and pass are stored.
    """
    per_unit = settings.lambda_steps_per_unit
    half = max(1, per_unit // 2)
    values = stage(_collapsed(df, keys, value), "values")
    extents = stage(_extents(values, keys), "extents")
    varied = extents.filter(F.col("lowest") < F.col("highest")).withColumn("n", F.col("n").cast("double"))
    passes = bracketed(values, varied, keys, settings)
    settled = reduce(DataFrame.unionByName, passes)
    around = lambda reach, step: F.sequence(F.col("best") - reach, F.col("best") + reach, step)
    near, wide = settled.filter(F.col("step") <= NEAR * half), settled.filter(F.col("step") > NEAR * half)
    if len(passes) > 1 and not wide.isEmpty():
        tried = wide.withColumn("points", _allowed(around(F.col("step"), F.lit(half)), settings)).drop("best")
        closer = stage(_placed(_score(values, tried, keys, settings), tried, keys, settings), "closer")
        near = near.unionByName(closer.withColumn("step", F.lit(half)))
    tried = near.withColumn("points", _allowed(around(F.col("step") + 1, F.lit(1)), settings)).drop("best")
    by_grid = Window.partitionBy(*keys).orderBy("grid")
    best = (
        _score(values, tried, keys, settings)
        .withColumns(
            {"before": F.lag("llf").over(by_grid), "after": F.lead("llf").over(by_grid)}
        )
        .groupBy(*keys)
        .agg(
            F.max_by(
                F.struct("grid", "before", "llf", "after"), F.struct("llf", -F.col("grid"))
            ).alias("best")
        )
    )
    return extents.join(best, keys, "left").select(
        *keys,
        F.coalesce(_peak(per_unit), F.lit(1.0)).alias("lambda"),
        F.col("n").cast("double").alias("length"),
    )


def _peak(per_unit: int) -> Column:
    """Top of the parabola through the best grid point and its neighbours."""
    bend = F.col("best.before") - 2 * F.col("best.llf") + F.col("best.after")
    step = F.when(bend < 0, (F.col("best.before") - F.col("best.after")) / (2 * bend))
    return (F.col("best.grid") + F.coalesce(step, F.lit(0.0))) / float(per_unit)


def with_transformed(
    df: DataFrame, exponents: DataFrame, keys: list[str], *columns: str
) -> DataFrame:
    """Add ``lambda``, ``length`` and, per column, its transform named ``<column>_t``.

    Keys must not be NULL; groups without an exponent get NULL. The exponents are one
    row per group. Their join carries no hint: the planner broadcasts them if they
    are small and splits a hot group if they are not.
    """
    joined = df.join(exponents, keys, "left")
    return joined.withColumns(
        {f"{c}_t": yeo_johnson(F.col(c), F.col("lambda")) for c in columns}
    )


def yeo_johnson_transform(
    df: DataFrame, keys: list[str], value: str, settings: Settings
) -> DataFrame:
    """Every row with its value transformed by its own group's exponent."""
    return with_transformed(df, yeo_johnson_lambda(df, keys, value, settings), keys, value)

"""General-ledger operators: versions, periods, account codes, roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.config import Settings
from sectorgauge.functions.columns import amount, exact_units, month_of, units, yes_no

CODE_LENGTH = 10


def choose_account_codes(accounts: DataFrame, settings: Settings) -> DataFrame:
    """One ledger code per account: the customer's if long enough, else the model's."""
    customer_ok = F.coalesce(
        F.length("rgscode") >= settings.customer_code_min, F.lit(False)
    )
    model_ok = F.coalesce(
        F.length("exactrgscode") >= settings.model_code_min, F.lit(False)
    )
    chosen = F.when(customer_ok, F.col("rgscode")).otherwise(F.col("exactrgscode"))
    return accounts.filter(customer_ok | model_ok).select(
        "id", "division", F.substring(chosen, 1, CODE_LENGTH).alias("rgscode")
    )


def current_transactions(transactions: DataFrame) -> DataFrame:
    """Latest version of every transaction; deleted ones disappear.

    The rank-1 filter becomes a partial group limit, so each scan task sends at
    most one row per id into the shuffle, however many versions the id has.
    """
    newest_first = Window.partitionBy("id").orderBy(
        F.desc("sysmodified"),
        F.desc("x_sysingested"),
        F.desc("glaccount"),
        F.desc("amountdc"),
        F.desc("entrydate"),
        F.desc("type"),
        F.desc("x_isdeleted"),
    )
    return (
        transactions.withColumn("version_rank", F.row_number().over(newest_first))
        .filter(F.col("version_rank") == 1)
        .filter(F.col("x_isdeleted") == "N")
        .drop("version_rank")
    )


def with_entry_period(transactions: DataFrame, settings: Settings) -> DataFrame:
    """Keep plausible dates; add the month bucket and the closing-entry flag."""
    date = F.col("entrydate").cast("string")
    month = month_of(F.col("entrydate"))
    return (
        transactions.filter(
            (date >= settings.entry_from) & (date < settings.entry_before)
        )
        .withColumn(
            "entryperiod",
            F.when(
                month < settings.oldest_month, F.lit(settings.older_label)
            ).otherwise(month),
        )
        .withColumn("hastype310", yes_no(F.col("type") == settings.closing_type))
    )


def account_months(transactions: DataFrame) -> DataFrame:
    """Amount and count per account, month and closing flag.

    Runs before the account join: what is joined is account-months, so an account
    with a third of all transactions arrives as a few hundred rows.
    """
    return transactions.groupBy("glaccount", "entryperiod", "hastype310").agg(
        F.sum(exact_units(F.col("amountdc"))).alias("units"),
        F.count("amountdc").alias("transactions"),
    )


def with_ledger_code(months: DataFrame, codes: DataFrame) -> DataFrame:
    """Inner join of account-months to the account's division and code."""
    return months.join(
        codes.withColumnRenamed("id", "glaccount"), "glaccount", "inner"
    ).select(
        "division", "entryperiod", "rgscode", "hastype310", "units", "transactions"
    )


def level_label(code: Column, closing: Column) -> Column:
    """``RGSL2`` / ``RGSL3`` / ``RGSL4`` by code length, marked when closing."""
    level = ((F.length(code) + 2) / 3).cast("int").cast("string")
    suffix = F.when(closing == "Y", F.lit("-hastype310")).otherwise(F.lit(""))
    return F.concat(F.lit("RGSL"), level, suffix)


def roll_up(coded: DataFrame, settings: Settings) -> DataFrame:
    """Sum account-months into every code level that the code is long enough for.

    One grouping serves all levels. Rows fan out to their levels inside the scan
    of the join result and are combined there, so a division with a large share of
    all accounts enters the shuffle as sums per code.
    """
    levels = sorted(settings.levels)
    fitting = F.lit(None).cast("array<int>")
    for count, shortest in enumerate(levels, start=1):
        fitting = F.when(
            F.length("rgscode") >= shortest, F.array(*[F.lit(n) for n in levels[:count]])
        ).otherwise(fitting)
    return (
        coded.withColumn("prefix_length", F.explode(fitting))
        .withColumn("aggregate", F.expr("substring(rgscode, 1, prefix_length)"))
        .groupBy("division", "entryperiod", "aggregate", "hastype310")
        .agg(F.sum("units").alias("units"), F.sum("transactions").alias("transactions"))
        .select(
            "division",
            "entryperiod",
            "aggregate",
            amount(F.col("units")).alias("value"),
            "transactions",
            level_label(F.col("aggregate"), F.col("hastype310")).alias("type"),
        )
    )


def ledger_measures(
    transactions: DataFrame, codes: DataFrame, settings: Settings
) -> DataFrame:
    """Change log and account codes to rolled-up monthly amounts per division."""
    current = with_entry_period(current_transactions(transactions), settings)
    return roll_up(with_ledger_code(account_months(current), codes), settings)


def bad_divisions(measures: DataFrame, settings: Settings) -> DataFrame:
    """Divisions whose stock or cash adds up to less than zero over all time."""
    return (
        measures.filter(F.col("aggregate").isin(*settings.bad_codes))
        .groupBy("division", "aggregate")
        .agg(amount(F.sum(units(F.col("value")))).alias("total"))
        .filter(F.col("total") < settings.negative_limit)
        .select("division")
        .distinct()
    )


def drop_bad_divisions(measures: DataFrame, bad: DataFrame) -> DataFrame:
    """Remove all measures of the given divisions."""
    return measures.join(bad, "division", "left_anti")

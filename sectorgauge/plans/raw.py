"""From bookkeeping and invoices to the long table of monthly measures."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sectorgauge.config import Settings
from sectorgauge.operators.divisions import eligible_divisions
from sectorgauge.operators.ledger import (
    bad_divisions,
    choose_account_codes,
    drop_bad_divisions,
    ledger_measures,
)
from sectorgauge.operators.payments import days_to_cash
from sectorgauge.sources.stages import stage


def raw_measures(
    accounts: DataFrame,
    transactions: DataFrame,
    invoices: DataFrame,
    lookup: DataFrame,
    settings: Settings,
) -> DataFrame:
    """Measures of eligible, not bad divisions.

    Eligibility is tested on the account dimension, before the ledger join, and
    on the aggregated days to cash, so excluded companies never reach the large
    shuffles of the roll-up.

    The ledger measures are stored before the bad divisions are looked up in them:
    reading two codes again is cheaper than computing the ledger twice. The bad
    divisions and the days to cash are stored too, so the result is a union of stored
    tables without a few divisions: it can be read more than once, and a caller need
    not write the largest table a second time.
    """
    eligible = eligible_divisions(lookup)
    codes = choose_account_codes(accounts, settings).join(
        eligible, "division", "left_semi"
    )
    ledger = stage(ledger_measures(transactions, codes, settings), "ledger")
    bad = stage(bad_divisions(ledger, settings), "bad-divisions")
    d2c = days_to_cash(invoices, settings).join(eligible, "division", "left_semi")
    d2c = stage(d2c, "days-to-cash")
    return drop_bad_divisions(ledger.unionByName(d2c), bad)

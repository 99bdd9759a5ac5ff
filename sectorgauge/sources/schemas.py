"""Columns and types of all stored tables."""

from __future__ import annotations

# Input tables. Parquet columns are matched without regard to case.
GL_ACCOUNT = "id bigint, division string, rgscode string, exactrgscode string"
GL_TRANSACTION = (
    "id string, type string, sysmodified timestamp, x_sysingested timestamp, "
    "x_isdeleted string, amountdc decimal(18,2), glaccount bigint, entrydate string"
)
INVOICE_DSO = (
    "division string, paymententrydate string, actualtimebetweeninvoiceandpayment int, "
    "paymentpaymentmethod string, paymentmethod string, paymentdays int, paymentid bigint, "
    "uniqueinvoicenumber bigint, matchid bigint"
)
DIVISION_LOOKUP = (
    "division string, country string, product string, sectorcode string, "
    "subsectorcode string, sizedescription string, allow_data_sharing string, group_id int, "
    "size_of_merged_group bigint, eurocurrency string"
)
FINANCIAL_PERIOD = (
    "division string, finyear int, finperiod int, startdate date, enddate date"
)

INPUTS = {
    "gl_account": GL_ACCOUNT,
    "gl_transaction": GL_TRANSACTION,
    "invoice_dso": INVOICE_DSO,
    "division_lookup": DIVISION_LOOKUP,
    "financial_period": FINANCIAL_PERIOD,
}

# Stage tables.
MEASURES = (
    "division string, entryperiod string, aggregate string, value double, "
    "transactions bigint, type string"
)
FLAGGED_KPIS = (
    "division string, aggregate string, value double, entryperiod string, "
    "is_1point5_iqr_outlier string, is_3point0_iqr_outlier string, percentile double, "
    "group_id int, size_of_merged_group bigint, size_of_group_per_period bigint, "
    "q1 double, q3 double, iqr double, kpi string"
)
SERIES = (
    "entryperiod string, sectorcode string, kpi string, unit string, population bigint, "
    "value double, deseasonalizedvalue double, trendvalue double"
)
ELEMENTS = "division string, entryperiod string, element string, cumvalue double"
FLAGGED_RATIOS = (
    "division string, entryperiod string, numerator double, denominator double, "
    "value double, kpi string, aggregate string, is_1point5_iqr_outlier string, "
    "is_3point0_iqr_outlier string, percentile double, group_id int, "
    "size_of_merged_group bigint, size_of_group_per_period bigint, q1 double, q3 double, "
    "iqr double, negative_stock_cash string"
)
CELLS = (
    "entryperiod string, sizedescription string, sectorcode string, subsectorcode string, "
    "value double, population bigint, kpi string, unit string"
)

# Serving tables.
SERIES_DOCUMENTS = (
    "kpi_identifier string, sectorcode string, kpi string, data array<struct<"
    "entryperiod: string, value: decimal(18,2), population: int, unit: string, "
    "deseasonalizedvalue: decimal(18,2), trendvalue: decimal(18,2)>>, updated timestamp"
)
RATIO_DOCUMENTS = (
    "kpi_identifier string, kpi string, sector string, subsector string, "
    "companysize string, value decimal(18,2), population int, updated timestamp"
)
BOOKMARKS = (
    "s3key string, servicename string, status string, created timestamp, updated timestamp"
)

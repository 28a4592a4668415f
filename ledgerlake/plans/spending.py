"""monthly_spending (G10): spend by category per month, with share of the month.

Spend is a positive amount (payments, credits and refunds are negative and
excluded).  The month total is a window sum over the already-aggregated
(month, category) rows, which replaces a second aggregation plus a join: the
only shuffle after the partial/final aggregate moves one row per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.numeric import pct

# Fixed value: label for transactions without an issuer category.
UNCATEGORIZED = "Uncategorized"

COLUMNS = ["month", "category", "total_spent", "transaction_count", "total_spent_month",
           "pct_of_month_spend"]


def monthly_spending(stg_transactions: DataFrame) -> DataFrame:
    spend = (stg_transactions.filter(F.col("amount") > 0)
             .select(F.trunc(F.col("transaction_date"), "month").cast("timestamp_ntz")
                     .alias("month"),
                     F.coalesce(F.col("category_raw"), F.lit(UNCATEGORIZED)).alias("category"),
                     F.col("amount")))
    by_cat = spend.groupBy("month", "category").agg(
        F.sum("amount").cast("decimal(38,2)").alias("total_spent"),
        F.count(F.lit(1)).alias("transaction_count"))
    month_total = F.sum("total_spent").over(Window.partitionBy("month")).cast("decimal(38,2)")
    return (by_cat.withColumn("total_spent_month", month_total)
            .withColumn("pct_of_month_spend", pct("total_spent", "total_spent_month", 1))
            .select(*COLUMNS))



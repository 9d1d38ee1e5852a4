"""Questions asked of the rule counts and the quarantine: rates, spikes, months, companies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.layers import with_company

#: A rule's rate is a spike from this many matched rows, at this many times the rate of the month loaded before.
SPIKE_ROWS, SPIKE_FACTOR = 100, 2


def monthly_summary(rule_counts: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows checked, quarantined and accepted per month, and the share quarantined."""
    checked = rule_counts.groupBy("data_month").agg(F.max("total_rows").alias("rows_checked"))
    bad = quarantine.groupBy("data_month").agg(F.count(F.lit(1)).alias("bad"))
    n = F.coalesce("bad", F.lit(0).cast("bigint"))
    return checked.join(bad, "data_month", "left").select(
        "data_month", "rows_checked", n.alias("rows_quarantined"), (F.col("rows_checked") - n).alias("rows_in_silver"),
        F.try_divide(n, F.col("rows_checked")).alias("quarantine_rate")
    )


def rule_rates(rule_counts: DataFrame) -> DataFrame:
    """Each rule's rate per month against the month loaded before (not the calendar month), and whether it is a spike."""
    order = Window.partitionBy("rule_id").orderBy("data_month")
    rate = F.try_divide("matched_rows", "total_rows")
    rows = rule_counts.withColumn("match_rate", rate).withColumn("previous_match_rate", F.lag("match_rate").over(order))
    spike = (F.col("matched_rows") >= SPIKE_ROWS) & (F.col("match_rate") >= SPIKE_FACTOR * F.col("previous_match_rate"))
    return rows.select(
        "data_month", "rule_id", "severity", "description", "matched_rows", "total_rows", "match_rate", "previous_match_rate",
        F.try_divide("match_rate", "previous_match_rate").alias("rate_vs_previous_month"), F.coalesce(spike, F.lit(False)).alias("is_spike")
    )


def quarantine_by_company(quarantine: DataFrame, companies: DataFrame) -> DataFrame:
    """Quarantined rows per month, failed rule and company; names are joined to the aggregate."""
    rows = quarantine.select("data_month", F.explode("failed_rules").alias("rule_id"), "hvfhs_license_num")
    return with_company(rows.groupBy("data_month", "rule_id", "hvfhs_license_num").agg(F.count(F.lit(1)).alias("rows_quarantined")), companies)


def counters(summary: DataFrame, rates: DataFrame) -> DataFrame:
    """``counter, value``: rows checked, rows quarantined, spikes."""
    s = summary.select(
        F.inline(
            F.array(
                F.struct(F.lit("rows_checked").alias("counter"), F.col("rows_checked").alias("n")),
                F.struct(F.lit("rows_quarantined").alias("counter"), F.col("rows_quarantined").alias("n"))
            )
        )
    )
    return s.unionByName(
        rates.select(F.lit("spikes").alias("counter"), F.col("is_spike").cast("bigint").alias("n"))
    ).groupBy("counter").agg(F.sum("n").alias("value"))


def spikes(rates: DataFrame) -> DataFrame:
    return rates.where("is_spike").select("data_month", "rule_id", "description", "matched_rows", "match_rate", "previous_match_rate", "rate_vs_previous_month")


def by_rule_month(by_company: DataFrame) -> DataFrame:
    return by_company.groupBy("data_month", "rule_id").agg(F.sum("rows_quarantined").alias("rows_quarantined"))


def spike_rules(rates: DataFrame) -> DataFrame:
    """The spiking rules of each month, sorted; an empty array where there are none."""
    return rates.groupBy("data_month").agg(F.array_sort(F.collect_list(F.when(F.col("is_spike"), F.col("rule_id")))).alias("spike_rules"))


#: The orders in which dashboards show the answers.
ORDERS = {"months": ["data_month"], "rules": ["data_month", "rule_id"], "companies": ["data_month", "rule_id", "company"]}


def shown(answer: DataFrame, order: str) -> DataFrame:
    """An answer in the order of its dashboard."""
    return answer.orderBy(*ORDERS[order])

"""Search-ad statistics with current names, and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsmart.functions.numbers import from_micros, ratio
from opsmart.functions.text import resource_id
from opsmart.operators.match import current_records

# Fixed value: marker before the group id in a resource path.
GROUP_MARKER = "adGroups/"

DIMENSIONS = [
    "date_day", "account_name", "account_id", "currency_code", "campaign_name", "campaign_id", "ad_group_name",
    "ad_group_id", "ad_id", "ad_name", "ad_status", "ad_type", "display_url", "source_final_urls",
]


def ads_modified(stats: DataFrame, accounts: DataFrame, campaigns: DataFrame, groups: DataFrame, ads: DataFrame) -> DataFrame:
    """Daily ad statistics under the current names of ad, group, campaign and account.

    Statistics are summed per day and ad before the joins: each dimension is
    unique on its key, so joining first would only move more rows.
    """
    per_ad = (
        stats.select(
            F.col("date").alias("date_day"),
            resource_id(F.col("ad_group_id"), F.col("ad_group_base_ad_group"), GROUP_MARKER).alias("_group"),
            "ad_id",
            "cost_micros",
            "clicks",
            "impressions",
            "conversions",
            "conversions_value",
        )
        .groupBy("date_day", "ad_id", "_group")
        .agg(
            F.sum("cost_micros").alias("cost_micros"),
            F.sum("clicks").alias("clicks"),
            F.sum("impressions").alias("impressions"),
            F.sum("conversions").alias("conversions"),
            F.sum("conversions_value").alias("conversions_value"),
        )
    )
    ad = current_records(ads).select(
        F.col("ad_id").alias("_ad"), F.col("ad_group_id").cast("string").alias("_ad_group"), "ad_name", "ad_status",
        "ad_type", "display_url", "source_final_urls",
    )
    group = current_records(groups).select(
        F.col("ad_group_id").cast("string").alias("ad_group_id"), "ad_group_name", F.col("campaign_id").alias("_campaign")
    )
    campaign = current_records(campaigns).select("campaign_id", "campaign_name", F.col("account_id").alias("_account"))
    account = current_records(accounts).select("account_id", "account_name", "currency_code")
    joined = (
        per_ad.join(ad, (F.col("ad_id") == F.col("_ad")) & (F.col("_group") == F.col("_ad_group")), "left")
        .join(group, F.col("_ad_group") == F.col("ad_group_id"), "left")
        .join(campaign, F.col("_campaign") == F.col("campaign_id"), "left")
        .join(account, F.col("_account") == F.col("account_id"), "left")
    )
    return joined.groupBy(*DIMENSIONS).agg(
        from_micros(F.sum("cost_micros")).alias("spend"),
        F.sum("clicks").alias("clicks"),
        F.sum("impressions").alias("impressions"),
        F.sum("conversions").alias("conversions"),
        F.sum("conversions_value").alias("conversions_value"),
    )


def ads_summary(modified: DataFrame) -> DataFrame:
    """Totals and rates per ad and group."""
    out = modified.groupBy("ad_id", "ad_group_id").agg(
        F.max("ad_name").alias("ad_name"),
        F.max("ad_type").alias("ad_type"),
        F.max("ad_group_name").alias("ad_group_name"),
        F.max("source_final_urls").alias("final_url"),
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("spend").alias("total_spend"),
        F.sum("conversions").alias("total_conversions"),
        F.sum("conversions_value").alias("total_conversions_value"),
    )
    shown, clicks, spend = F.col("total_impressions"), F.col("total_clicks"), F.col("total_spend")
    return out.withColumns(
        {
            "ctr": ratio(clicks, shown, per=100),
            "cpc": ratio(spend, clicks),
            "roas": ratio(F.col("total_conversions_value"), spend),
            "cpcv": ratio(spend, F.col("total_conversions")),
        }
    )


def ads_agg(ads: DataFrame) -> DataFrame:
    """Impressions, clicks and spend per ad and group."""
    return ads.groupBy("ad_id", "ad_group_id").agg(
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("spend").alias("total_spend"),
    )


def ad_stats_agg(stats: DataFrame) -> DataFrame:
    """Conversions per ad and group; the group stays in the output."""
    return stats.groupBy("ad_id", "ad_group_id").agg(
        F.sum("conversions").alias("total_conversions"), F.sum("conversions_value").alias("total_conversions_value")
    )


def ad_groups_agg(groups: DataFrame) -> DataFrame:
    return groups.groupBy("ad_group_id").agg(F.max("ad_group_name").alias("ad_group_name"))

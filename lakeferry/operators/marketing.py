"""Nested advertising reports to flat daily rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.functions.text import country_prefix, leading_word, local_day

# Layouts of the landed reports. Spend may arrive as text or number, so it is read as text; the app
# is read as text as well, which keeps its JSON with all keys.
APPLE_SCHEMA = """
    metadata struct<
        campaignId: bigint, adChannelType: string, app: string,
        campaignName: string, campaignStatus: string, countriesOrRegions: array<string>, deleted: boolean,
        displayStatus: string, modificationTime: string, servingStatus: string,
        totalBudget: struct<amount: string, currency: string>,
        totalRemainingBudget: struct<amount: string, currency: string>>,
    granularity array<struct<
        date: string, impressions: bigint, localSpend: struct<amount: string, currency: string>,
        newDownloads: bigint, redownloads: bigint, taps: bigint>>
"""
SNAPCHAT_SCHEMA = """
    execution_ts timestamp,
    campaigns array<struct<
        campaign: struct<id: string, name: string>,
        ads: array<struct<
            ad: struct<id: string, name: string, ad_squad_id: string, creative_id: string>,
            timeseries: array<struct<stats: struct<
                spend: double, impressions: bigint, swipes: bigint, swipe_up_percent: double,
                view_time_millis: bigint, screen_time_millis: bigint, video_views: bigint,
                android_installs: bigint, ios_installs: bigint, uniques: bigint>>>>>>>
"""
TIKTOK_SCHEMA = """
    account_country string,
    list array<struct<
        dimensions: struct<stat_time_day: string, ad_id: bigint>,
        metrics: struct<
            ad_name: string, adgroup_id: bigint, adgroup_name: string, campaign_id: bigint, campaign_name: string,
            spend: string, reach: bigint, impressions: bigint, clicks: bigint, video_play_actions: bigint,
            video_watched_2s: bigint, video_watched_6s: bigint, average_video_play: double,
            video_views_p25: bigint, video_views_p50: bigint, video_views_p75: bigint, video_views_p100: bigint,
            profile_visits: bigint, likes: bigint, comments: bigint, shares: bigint, follows: bigint>>>
"""

# Defaults of the reports.
VAT_FACTOR = 1.25
SNAPCHAT_CURRENCY = "EUR"
TIKTOK_CURRENCY = "SEK"
TIKTOK_COUNTRIES = ("SE", "DE", "FI", "NO")
TIKTOK_DEFAULT_COUNTRY = "SE"
REPORT_ZONE = "Europe/Stockholm"
# The figures of one advertisement.
SNAPCHAT_COUNTS = (
    "view_time_millis screen_time_millis video_views android_installs ios_installs uniques".split()
)
TIKTOK_METRICS = (
    "ad_name adgroup_id adgroup_name campaign_id campaign_name spend reach impressions clicks video_play_actions "
    "video_watched_2s video_watched_6s average_video_play video_views_p25 video_views_p50 video_views_p75 "
    "video_views_p100 profile_visits likes comments shares follows"
).split()


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def _number(column: Column) -> Column:
    return F.coalesce(column.try_cast("double"), F.lit(0.0))


def apple_rows(reports: DataFrame) -> DataFrame:
    """One row per campaign with spend; the first granularity entry counts."""
    meta = F.col("metadata")
    first = F.get("granularity", F.lit(0))
    spend = _number(first["localSpend"]["amount"])
    return reports.filter(spend != 0).select(
        first["date"].alias("date"),
        meta["campaignId"].alias("campaign_id"),
        meta["adChannelType"].alias("ad_channel_type"),
        F.coalesce(meta["app"], F.lit("{}")).alias("app_dict"),
        meta["campaignName"].alias("campaign_name"),
        meta["campaignStatus"].alias("campaign_status"),
        F.array_join(meta["countriesOrRegions"], ",").alias("countries"),
        F.coalesce(meta["deleted"], F.lit(False)).alias("deleted"),
        meta["displayStatus"].alias("display_status"),
        meta["modificationTime"].alias("modification_time"),
        meta["servingStatus"].alias("serving_status"),
        _number(meta["totalBudget"]["amount"]).alias("total_budget"),
        _number(meta["totalRemainingBudget"]["amount"]).alias("total_remaining_budget"),
        _or_zero(first["impressions"]).alias("impressions"),
        spend.alias("local_spend"),
        first["localSpend"]["currency"].alias("currency_code"),
        _or_zero(first["newDownloads"]).alias("new_downloads"),
        _or_zero(first["redownloads"]).alias("redownloads"),
        _or_zero(first["taps"]).alias("taps"),
    )


def snapchat_rows(
    reports: DataFrame,
    vat_factor: float = VAT_FACTOR,
    currency: str = SNAPCHAT_CURRENCY,
    zone: str = REPORT_ZONE,
) -> DataFrame:
    """One row per advertisement and day with spend, from campaigns -> ads -> daily stats."""
    stats = (
        reports.select("execution_ts", F.explode("campaigns").alias("c"))
        .select("execution_ts", F.col("c.campaign").alias("campaign"), F.explode("c.ads").alias("a"))
        .select("execution_ts", "campaign", F.col("a.ad").alias("ad"), F.explode("a.timeseries.stats").alias("s"))
        .filter("s.spend > 0")
    )
    return stats.select(
        local_day(F.col("execution_ts"), zone).alias("date"),
        F.col("ad.id").alias("ad_id"),
        F.col("ad.name").alias("ad_name"),
        "ad.ad_squad_id",
        "ad.creative_id",
        F.col("campaign.id").alias("campaign_id"),
        F.col("campaign.name").alias("campaign_name"),
        leading_word(F.col("campaign.name")).alias("country_code"),
        (F.col("s.spend") / 1_000_000 * vat_factor).alias("spend"),
        F.lit(currency).alias("currency_code"),
        _or_zero(F.col("s.impressions")).alias("impressions"),
        _or_zero(F.col("s.swipes")).alias("swipes"),
        "s.swipe_up_percent",
        *[_or_zero(F.col(f"s.{c}")).alias(c) for c in SNAPCHAT_COUNTS],
    )


def tiktok_rows(
    reports: DataFrame,
    vat_factor: float = VAT_FACTOR,
    currency: str = TIKTOK_CURRENCY,
    countries: Sequence[str] = TIKTOK_COUNTRIES,
    default_country: str = TIKTOK_DEFAULT_COUNTRY,
) -> DataFrame:
    """One row per advertisement and day with spend.

    The country comes from the campaign name. ``account_country`` is kept as well: it is
    what a reload must replace by, because the two can differ.
    """
    ads = reports.select("account_country", F.inline("list"))
    spend = F.col("metrics.spend").try_cast("double")
    metrics = [
        (spend * vat_factor).alias("spend") if m == "spend" else F.col(f"metrics.{m}").alias(m) for m in TIKTOK_METRICS
    ]
    # a missing name stands for the default country
    name = F.coalesce(F.col("metrics.campaign_name"), F.lit(default_country))
    return ads.filter(spend > 0).select(
        F.col("dimensions.stat_time_day").try_cast("timestamp").alias("date"),
        F.col("dimensions.ad_id").alias("ad_id"),
        country_prefix(name, countries, default_country).alias("country_code"),
        F.lit(currency).alias("currency_code"),
        *metrics,
        "account_country",
    )

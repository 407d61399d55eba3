"""Marketing funnel: awareness, interest, desire, intent, purchase, retention.

Every source is brought to one row per day before it meets the calendar, so
facts are scanned once and the joins are calendar-sized.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsmart.functions.numbers import money, ratio
from opsmart.operators.metrics import count_if, event_columns, sum_if
from opsmart.operators.series import forward_fill, running_sums, weighted_age


def _day(ts: str) -> Column:
    return F.col(ts).cast("date").alias("date")


def _days(spine: DataFrame) -> DataFrame:
    return spine.select("date")


def valid_orders(orders: DataFrame, marketplace: str) -> DataFrame:
    """Confirmed, real, undeleted orders that did not come from the marketplace.
    Orders without any source name are left out too."""
    return orders.filter(
        F.col("is_confirmed")
        & ~F.col("is_test_order")
        & ~F.col("is_deleted")
        & (F.col("source_name") != marketplace)
    )


def awareness(spine: DataFrame, search: DataFrame, social: DataFrame, photo: DataFrame, market: DataFrame) -> DataFrame:
    """Impressions, clicks, spend, cost per mille and click rate per channel and day.

    ``search``, ``social``: date_day, impressions, clicks, spend (one row a day).
    ``photo``: date, impressions, website_clicks. ``market``: date, impressions,
    clicks, cost per ad group.
    """
    per_day = market.groupBy("date").agg(
        F.sum("impressions").alias("amazon_impressions"),
        F.sum("clicks").alias("amazon_clicks"),
        F.sum(money(F.col("cost"))).cast("double").alias("amazon_ad_spend"),
    )

    def account(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.col("date_day").alias("date"),
            F.col("impressions").alias(f"{name}_impressions"),
            F.col("clicks").alias(f"{name}_clicks"),
            F.col("spend").alias(f"{name}_spend"),
        )

    organic = photo.select(
        "date", F.col("impressions").alias("instagram_impressions"), F.col("website_clicks").alias("instagram_clicks")
    )
    out = _days(spine)
    for part in (account(search, "google_ad"), account(social, "facebook_ad"), organic, per_day):
        out = out.join(part, "date", "left")

    def cpm(spend: str, shown: str) -> Column:
        return F.try_divide(F.lit(1000) * F.col(spend), F.col(shown).cast("double"))

    def ctr(clicks: str, shown: str) -> Column:
        return ratio(F.col(clicks), F.col(shown), per=100)

    return out.select(
        "date",
        "google_ad_impressions", "facebook_ad_impressions", "instagram_impressions", "amazon_impressions",
        "google_ad_clicks", "facebook_ad_clicks", "instagram_clicks", "amazon_clicks",
        "google_ad_spend", "facebook_ad_spend", "amazon_ad_spend",
        cpm("google_ad_spend", "google_ad_impressions").alias("google_ad_cpm"),
        cpm("facebook_ad_spend", "facebook_ad_impressions").alias("facebook_ad_cpm"),
        cpm("amazon_ad_spend", "amazon_impressions").alias("amazon_ad_cpm"),
        ctr("google_ad_clicks", "google_ad_impressions").alias("google_ad_ctr"),
        ctr("facebook_ad_clicks", "facebook_ad_impressions").alias("facebook_ad_ctr"),
        ctr("instagram_clicks", "instagram_impressions").alias("instagram_ctr"),
        ctr("amazon_clicks", "amazon_impressions").alias("amazon_ctr"),
    )


def desire(spine: DataFrame, ecommerce: DataFrame, events: DataFrame, brand: str) -> DataFrame:
    """Sessions, engagement and product interest per day.

    ``non_engagement_rate`` is 100 minus the engagement rate (the original view
    repeats the engagement formula under that name).
    """
    per_day = event_columns(
        events,
        {
            "total_sessions": ("session_start", "total_users"),
            "total_engagements": ("user_engagement", "total_users"),
            "total_product_views": ("view_item", "total_users"),
        },
    )
    items = ecommerce.filter(F.col("item_brand") == brand).select("date", "items_added_to_cart", "cart_to_view_rate")
    sessions = F.col("total_sessions")
    engaged = ratio(F.col("total_engagements"), sessions, per=100)
    return (
        _days(spine)
        .join(items, "date", "left")
        .join(per_day, "date", "left")
        .select(
            "date",
            "total_sessions",
            "total_engagements",
            "total_product_views",
            (sessions * F.col("cart_to_view_rate")).alias("total_add_to_carts"),
            "items_added_to_cart",
            engaged.alias("engagement_rate"),
            (F.lit(100.0) - engaged).alias("non_engagement_rate"),
            ratio(F.col("total_product_views"), sessions, per=100).alias("item_view_rate"),
            (F.col("cart_to_view_rate") * 100).alias("add_to_cart_rate"),
        )
    )


def intent(spine: DataFrame, orders: DataFrame, daily_shop: DataFrame, events: DataFrame, marketplace: str) -> DataFrame:
    """Orders, discounts, refunds, abandoned checkouts and conversion per day."""
    sold = valid_orders(orders, marketplace).groupBy(_day("created_timestamp")).agg(
        F.count("order_id").alias("orders"),
        F.sum(money(F.col("total_line_items_price"))).cast("double").alias("gross_sales"),
        count_if(F.col("total_discounts") > 0).alias("orders_with_discounts"),
        F.sum(money(F.col("total_discounts"))).cast("double").alias("total_discounts"),
        count_if(F.col("refund_subtotal") > 0).alias("orders_with_refunds"),
        F.sum(money(F.col("refund_subtotal"))).cast("double").alias("total_refunds"),
    )
    shop = daily_shop.select(
        F.col("date_day").alias("date"),
        F.col("count_abandoned_checkouts").alias("checkouts_abandoned"),
        F.col("count_customers_abandoned_checkout").alias("customers_abandoned"),
    )
    sessions = event_columns(events, {"total_sessions": ("session_start", "total_users")})
    orders_n, left = F.col("orders"), F.col("checkouts_abandoned")
    return (
        _days(spine)
        .join(sold, "date", "left")
        .join(shop, "date", "left")
        .join(sessions, "date", "left")
        .select(
            "date",
            "gross_sales",
            "orders",
            "orders_with_discounts",
            ratio(F.col("orders_with_discounts"), orders_n, per=100).alias("discounted_order_ratio"),
            ratio(F.col("total_discounts"), F.col("gross_sales"), per=100).alias("discount_ratio"),
            "orders_with_refunds",
            ratio(F.col("total_refunds"), F.col("gross_sales"), per=100).alias("refund_ratio"),
            ratio(F.col("orders_with_refunds"), orders_n, per=100).alias("order_refund_ratio"),
            (orders_n + left).alias("total_checkouts"),
            "checkouts_abandoned",
            ratio(left, orders_n + left, per=100).alias("abandoned_checkout_ratio"),
            "customers_abandoned",
            "total_sessions",
            ratio(orders_n, F.col("total_sessions"), per=100).alias("conversion_rate_sessions"),
        )
    )


def subscriber_changes(customers: DataFrame) -> DataFrame:
    """New and lost e-mail subscribers, both on the customer's creation day."""
    state, changed, made = (
        F.col("marketing_consent_state"), F.col("marketing_consent_updated_at"), F.col("created_timestamp"),
    )
    left = state.isin("unsubscribed", "not_subscribed")
    joined = (left & (changed > made)) | ((state == "subscribed") & (changed >= made))
    gone = (state == "unsubscribed") | ((state == "not_subscribed") & changed.isNotNull())
    return customers.groupBy(_day("created_timestamp")).agg(
        count_if(joined).alias("new_subscribers"), count_if(gone).alias("unsubscribers")
    )


def subscriber_list(spine: DataFrame, customers: DataFrame) -> DataFrame:
    """List size (carried over quiet days) and daily changes per calendar day."""
    changes = subscriber_changes(customers)
    sized = running_sums(changes, [], ["date"], {"_in": "new_subscribers", "_out": "unsubscribers"})
    sized = sized.withColumn("list_size", F.col("_in") - F.col("_out")).drop("_in", "_out")
    out = forward_fill(_days(spine).join(sized, "date", "left"), [], "date", ["list_size"])
    new, gone = F.coalesce("new_subscribers", F.lit(0)), F.coalesce("unsubscribers", F.lit(0))
    return out.select(
        "date",
        F.col("list_size").alias("email_list"),
        new.alias("email_new_subscribers"),
        gone.alias("email_unsubscribers"),
        (new - gone).alias("email_net_additions"),
    )


def interest(spine: DataFrame, content: DataFrame, events: DataFrame, social_history: DataFrame,
             customers: DataFrame) -> DataFrame:
    """Site traffic, social followers and the e-mail list per day, in date order."""
    per_day = event_columns(
        events,
        {
            "first_visits": ("first_visit", "event_count"),
            "session_starts": ("session_start", "event_count"),
            "scrolls": ("scroll", "event_count"),
            "clicks": ("click", "event_count"),
        },
    )
    followers = social_history.groupBy(_day("_fivetran_synced")).agg(F.max("followers_count").alias("followers"))
    filled = forward_fill(_days(spine).join(followers, "date", "left"), [], "date", ["followers"])
    site = content.select(
        "date", "new_users", "total_users", F.col("screen_page_views").alias("page_views"), "user_engagement_duration"
    )
    out = _days(spine)
    for part in (site, per_day, filled, subscriber_list(spine, customers)):
        out = out.join(part, "date", "left")
    users, sessions = F.col("total_users"), F.col("session_starts")
    return out.select(
        "date",
        "new_users",
        "total_users",
        "session_starts",
        "first_visits",
        "page_views",
        "scrolls",
        "clicks",
        ratio(F.col("page_views"), users).alias("page_views_per_user"),
        ratio(F.col("scrolls"), sessions, per=100).alias("scroll_rate_session"),
        ratio(F.col("clicks"), sessions, per=100).alias("click_rate_session"),
        "user_engagement_duration",
        ratio(F.col("user_engagement_duration"), sessions).alias("avg_time_on_site_session"),
        ratio(F.col("user_engagement_duration"), users).alias("avg_time_on_site_user"),
        F.col("followers").alias("instagram_followers"),
        "email_list",
        "email_new_subscribers",
        "email_unsubscribers",
        "email_net_additions",
    ).orderBy("date")


def purchase(spine: DataFrame, orders: DataFrame, spend: DataFrame, marketplace: str) -> DataFrame:
    """New against repeat orders and sales, and paid media cost per order.
    ``spend`` is :func:`awareness` or any frame with its two spend columns."""
    kind, price = F.col("new_vs_repeat"), money(F.col("total_price"))
    sold = valid_orders(orders, marketplace).groupBy(_day("created_timestamp")).agg(
        F.count("order_id").alias("orders"),
        count_if(kind == "new").alias("orders_from_new"),
        count_if(kind == "repeat").alias("orders_from_repeat"),
        F.sum(price).cast("double").alias("net_sales"),
        sum_if(kind == "new", price).cast("double").alias("net_sales_new"),
        sum_if(kind == "repeat", price).cast("double").alias("net_sales_repeat"),
    )
    paid = spend.select("date", "google_ad_spend", "facebook_ad_spend")
    google = F.coalesce("google_ad_spend", F.lit(0.0))
    facebook = F.coalesce("facebook_ad_spend", F.lit(0.0))
    return (
        _days(spine)
        .join(sold, "date", "left")
        .join(paid, "date", "left")
        .select(
            "date",
            "orders",
            "orders_from_new",
            "orders_from_repeat",
            ratio(F.col("orders_from_new"), F.col("orders"), per=100).alias("new_customer_ratio"),
            "net_sales",
            "net_sales_new",
            "net_sales_repeat",
            ratio(F.col("net_sales"), F.col("orders")).alias("aov"),
            google.alias("google_ad_spend"),
            facebook.alias("facebook_ad_spend"),
            (google + facebook).alias("total_paid_media_spend"),
            ratio(google + facebook, F.col("orders")).alias("blended_cpa"),
        )
    )


def _monthly(orders: DataFrame, marketplace: str) -> DataFrame:
    """Everything the retention reports need, per order month, in one pass.

    Orders shrink to one row per customer and month; the first month of a
    customer is a minimum over those few rows, so even a customer with a third
    of all orders is no more than the calendar's months in that window. Orders
    without a customer count as one new customer, but never as a repeat one.
    """
    month = F.trunc(F.col("created_timestamp").cast("date"), "month").alias("month")
    per_month = valid_orders(orders, marketplace).groupBy("customer_id", month).agg(
        F.count("order_id").alias("orders"),
        F.sum(money(F.col("total_price"))).alias("revenue"),
        F.count("total_price").alias("priced"),
    )
    first = F.min("month").over(Window.partitionBy("customer_id"))
    per_month = per_month.withColumn("is_first", F.col("month") == first)
    known = F.col("customer_id").isNotNull()
    return per_month.groupBy(F.col("month").alias("order_month")).agg(
        F.sum("orders").alias("order_count"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("revenue").alias("revenue"),
        F.sum("priced").alias("priced"),
        F.count_if("is_first").alias("new_customers"),
        F.count_if(~F.col("is_first") & known).alias("repeat_customers"),
    )


def _cohorts(spine: DataFrame, monthly: DataFrame) -> DataFrame:
    """Months of the calendar that won a customer, with age and lifespan."""
    months = spine.select(F.col("date").alias("_d"), "month_year", "month_number", "year")
    won = monthly.filter("new_customers > 0").withColumnRenamed("order_month", "first_order_month")
    out = won.join(months, F.col("first_order_month") == F.col("_d"), "inner").drop("_d")
    order = ["year", "month_number"]
    out = weighted_age(out, order, "new_customers", "weighted_months", "all_customers")
    out = running_sums(out, [], order, {"months_since_inception": F.lit(1)})
    return out.withColumn("avg_lifespan", ratio(F.col("weighted_months"), F.col("all_customers")))


def retention_cohorts(spine: DataFrame, orders: DataFrame, marketplace: str) -> DataFrame:
    """New customers per first-order month, their running total, the number of
    customer-winning months so far, and the average lifespan."""
    return _cohorts(spine, _monthly(orders, marketplace)).select(
        "month_year",
        "year",
        "month_number",
        "first_order_month",
        "new_customers",
        "all_customers",
        "months_since_inception",
        "weighted_months",
        "avg_lifespan",
    )


def cumulative_orders(orders: DataFrame, marketplace: str) -> DataFrame:
    """Orders per month and their running total."""
    monthly = _monthly(orders, marketplace).select("order_month", F.col("order_count").alias("monthly_order_count"))
    return running_sums(monthly, [], ["order_month"], {"cumulative_order_count": "monthly_order_count"})


def repeat_customers(orders: DataFrame, marketplace: str) -> DataFrame:
    """Distinct customers per month who had already ordered in an earlier one."""
    return _monthly(orders, marketplace).filter("repeat_customers > 0").select("order_month", "repeat_customers")


def retention(spine: DataFrame, orders: DataFrame, marketplace: str) -> DataFrame:
    """Monthly retention and lifetime value, in month order.

    ``cumulative_unique_customers`` adds up the distinct customers of each
    month, so a customer active in three months counts three times; the ratios
    built on it follow that reading.
    """
    monthly = running_sums(
        _monthly(orders, marketplace), [], ["order_month"], {"cumulative_order_count": "order_count"}
    )
    out = running_sums(
        _cohorts(spine, monthly),
        [],
        ["year", "month_number"],
        {"cumulative_unique_customers": "unique_customers", "_revenue_so_far": "revenue"},
    )
    customers_so_far = F.col("cumulative_unique_customers")
    value = F.coalesce(ratio(F.col("_revenue_so_far"), customers_so_far), F.lit(0.0))
    share = F.when(
        F.col("unique_customers") > 0, ratio(F.col("repeat_customers"), F.col("unique_customers"), per=100)
    ).otherwise(F.lit(0.0))
    return out.select(
        "month_year",
        "year",
        "month_number",
        "first_order_month",
        "order_count",
        "new_customers",
        "unique_customers",
        "cumulative_unique_customers",
        "repeat_customers",
        share.alias("repeat_customer_percentage"),
        ratio(F.col("cumulative_order_count"), customers_so_far).alias("average_lifetime_orders"),
        F.col("_revenue_so_far").cast("double").alias("cumulative_total_revenue"),
        F.col("revenue").cast("double").alias("total_revenue"),
        ratio(F.col("revenue"), F.col("priced")).alias("monthly_aov"),
        F.try_divide(value, F.col("avg_lifespan")).alias("arpu_per_month"),
        "avg_lifespan",
        value.alias("clv"),
    ).orderBy("year", "month_number")

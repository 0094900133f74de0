"""Dashboard tables: archives and current marts joined at a cut-over date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorledger import values as V
from motorledger.functions.classes import map_status, stock_age_class
from motorledger.functions.dates import NTZ, days_between, parse_cn_date, same_month, when_at
from motorledger.functions.nulls import not_in, zero
from motorledger.functions.numbers import loan_term
from motorledger.functions.text import bank_name, normalize_text
from motorledger.operators.columns import fill_from, rename_existing, times
from motorledger.operators.joins import flag_in, latest_lookup, left_lookup, qualify_store, stack_keys
from motorledger.operators.keep import first_per_key, tenure
from motorledger.operators.rows import exclude_today
from motorledger.operators.unions import relabel_positions, union_at_cutover, union_outer


def _or_empty(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def sales(current: DataFrame, archive: DataFrame, store_dim: DataFrame, cutover: str = V.CUTOVER) -> DataFrame:
    """All sales; transfers count as other business that left the house."""
    now = times(current, "sale_date").withColumn("term_label", loan_term("term"))
    old = archive.withColumn("sale_date", parse_cn_date(F.col("sale_date").cast("string")))
    both = union_outer(now, old.where(F.col("sale_date") < when_at(cutover)))
    moved = F.col("team") == V.TEAM_TRANSFER
    described = F.concat("series", F.lit(" "), "trim")
    both = both.withColumn("vehicle_info", F.when(moved, described).otherwise(F.col("vehicle_info")))
    both = both.withColumn("team", F.when(moved, F.lit(V.TEAM_OTHER)).otherwise(F.col("team")))
    other = F.col("team") == V.TEAM_OTHER
    both = both.withColumns(
        {
            "finance_type": F.when(other, F.lit(V.FINANCE_TRANSFER_OUT)).otherwise(F.col("finance_type")),
            "transferred_out": F.when(other, F.lit(V.YES)).otherwise(F.lit("")),
            "trim": F.coalesce("trim", "model"),
            "receipt_date": F.when(zero("used_rebate") != 0, F.coalesce("receipt_date", "sale_date")).otherwise(F.col("receipt_date")),
        }
    )
    networks = store_dim.groupBy("store").agg(F.min("network").alias("network"))
    return left_lookup(both.drop("network"), networks, ["store"])


def delivered(current: DataFrame, archive: DataFrame, stock: DataFrame, cutover: str = V.CUTOVER) -> DataFrame:
    """Delivered vehicles with a flag for orders of the same month."""
    now = times(current, "order_date", "sale_date").where(not_in("team", V.DASHBOARD_TEAMS_DROPPED))
    now = now.withColumn("sold_in_month", same_month("order_date", "sale_date", 1, 0))
    old = times(archive, "order_date", "sale_date").where(F.col("sale_date") < when_at(cutover))
    both = union_outer(now, old)
    arrivals = stock.select("vin", F.col("arrival_date").alias("_arrived"))
    both = latest_lookup(both, arrivals, ["vin"], ["_arrived"], ["_arrived"])
    both = both.withColumn("arrival_date", F.coalesce(F.col("arrival_date"), F.col("_arrived"))).drop("_arrived")
    return fill_from(both, "trim", "model")


def booked(current: DataFrame, archive: DataFrame, cutover: str = V.CUTOVER) -> DataFrame:
    """Approved orders; the cut-over moment itself belongs to the current side."""
    now = current.where(F.col("approval") == V.APPROVED)
    both = union_at_cutover(times(now, "order_date"), times(archive, "order_date"), "order_date", cutover)
    return fill_from(both, "trim", "model")


def cancelled(current: DataFrame, archive: DataFrame, cutover: str = V.CUTOVER) -> DataFrame:
    now = current.where(not_in("void_type", V.VOID_IGNORED))
    old = times(archive, "cancel_date").where(F.col("cancel_date") < when_at(cutover))
    return union_outer(times(now, "order_date", "cancel_date"), times(old, "order_date"))


def all_orders(booked_orders: DataFrame, cancelled_orders: DataFrame) -> DataFrame:
    """Orders and cancellations together, dated by the later event."""
    both = union_outer(booked_orders.withColumn("not_counted", F.lit(-1)), cancelled_orders)
    return both.withColumn("effective_date", F.coalesce("cancel_date", "order_date"))


def stock(current: DataFrame, plan_dates: DataFrame) -> DataFrame:
    """Stock with its age class and the lead time from plan to arrival."""
    out = current.withColumn("age_class", stock_age_class("stock_days", "vehicle_status"))
    plans = stack_keys(plan_dates, ["purchase_no", "service_no", "change_no"], "plan_date", "purchase_no")
    out = left_lookup(out, plans, ["purchase_no"])
    out = times(out, "arrival_date", "plan_date", "shipped_date").withColumn("_plan", F.coalesce("plan_date", "shipped_date"))
    return out.withColumn("lead_days", days_between("arrival_date", "_plan", inclusive=True)).drop("_plan")


def accessories(
    current: DataFrame, archive: DataFrame, store_dim: DataFrame, series_dim: DataFrame,
    district: str, cutover: str = V.CUTOVER,
) -> DataFrame:
    """Accessory sales; one district stays in the archive after the cut-over."""
    now = times(rename_existing(current, {"first_receipt": "sold_date"}), "sold_date")
    districts = store_dim.groupBy("store").agg(F.min("district").alias("district"))
    old = left_lookup(times(archive, "sold_date"), districts, ["store"])
    both = union_at_cutover(now, old, "sold_date", cutover, F.col("district") == district)
    return qualify_store(both, series_dim, "store", "series", "network")


def bills(current: DataFrame, archive: DataFrame, cutover: str = V.CUTOVER) -> DataFrame:
    """Open bills, bills redeemed since the cut-over, and redeemed archive bills."""
    now = times(current, "issue_date").withColumns(
        {"newest_due": F.col("due_date"), "redeemed": F.col("redeemed").try_cast("int")}
    )
    kept = (F.col("redeemed") == 0) | ((F.col("redeemed") == 1) & (F.col("issue_date") >= when_at(cutover)))
    old = times(archive, "issue_date").withColumn("redeemed", F.col("redeemed").try_cast("int"))
    both = union_outer(now.where(kept), old.where(F.col("redeemed") == 1))
    return both.withColumn("bank", bank_name("bank"))


def used_cars(current: DataFrame, archive: DataFrame, names: dict[str, str]) -> DataFrame:
    return union_outer(archive, rename_existing(current.select(*names), names))


def unsold_locked(df: DataFrame, cols: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Locked but unsold vehicles that are in stock or on the way."""
    status = map_status("vehicle_status", {V.PLANNED: V.NOT_SHIPPED, V.IN_TRANSIT: V.IN_TRANSIT}, V.IN_STOCK)
    out = df.where(F.col("lock_date").isNotNull()).withColumn("vehicle_status", status)
    out = out.where(F.col("vehicle_status").isin(V.IN_STOCK, V.IN_TRANSIT))
    return relabel_positions(out.select(*cols), names)


def renamed_series(df: DataFrame, old: str, price: float, new: str) -> DataFrame:
    """One series is split by its settlement price."""
    df = df.withColumn("settle_price", F.col("settle_price").try_cast("double"))
    hit = (F.col("series") == old) & (F.col("settle_price") == price)
    return df.withColumn("series", F.when(hit, F.lit(new)).otherwise(F.col("series")))


def with_kind(df: DataFrame, series_dim: DataFrame) -> DataFrame:
    kinds = series_dim.groupBy("series").agg(F.min("kind").alias("kind"))
    return left_lookup(df.drop("kind"), kinds, ["series"])


def finished_sales(df: DataFrame, series_dim: DataFrame, as_of: datetime) -> DataFrame:
    """Complete days only, with the kind of series."""
    if as_of.hour < V.EVENING_HOUR:
        df = df.withColumn("sale_date", F.coalesce(F.col("sale_date"), F.col("receipt_date")).cast(NTZ))
    return with_kind(exclude_today(df, "sale_date", as_of), series_dim)


def seller_tenure(df: DataFrame) -> DataFrame:
    return tenure(df.where(F.col("seller").isNotNull()), "seller", "store", "sale_date")


def with_key_account(df: DataFrame, key_accounts: DataFrame) -> DataFrame:
    return flag_in(df, key_accounts, "purchase_no", "key_account", V.KEY_ACCOUNT, V.NOT_KEY_ACCOUNT)


def catalogue(sources: Sequence[DataFrame]) -> DataFrame:
    """One row per series and trim, whatever the spelling; pseudo series are left out.

    Each source has series, model, trim, colour. Sources rank in the given order.
    """
    ranked = [s.select("series", "model", "trim", "colour").withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    both = union_outer(*ranked)
    both = both.withColumn("model", F.coalesce("model", "trim"))
    both = both.withColumn("_text", normalize_text(F.concat(_or_empty("series"), _or_empty("trim"))))
    out = first_per_key(both, ["_text"], ["_source"]).drop("_text", "_source")
    out = out.withColumn("model", F.trim(F.replace("model", F.lit("\n"), F.lit(" "))))
    return out.where(not_in("series", V.SALE_PSEUDO_SERIES))

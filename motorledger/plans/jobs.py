"""Whole runs: marts, dashboards, application tables and ledgers, each shared result written once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorledger import values as V
from motorledger.operators.groups import summary
from motorledger.operators.joins import left_lookup
from motorledger.operators.rows import drop_soft_deleted, prefer_rows
from motorledger.operators.unions import union_outer
from motorledger.plans import accessories, app, costs, dashboard, film, finance, orders, products, sales, scores, stock
from motorledger.session import written
from motorledger.sources.sinks import exists, load_report, read_current, write_documents, write_replace


@dataclass(frozen=True)
class MartSettings:
    """What differs from house to house."""

    internal_companies: Sequence[str] = ()
    companies: Sequence[str] = ()
    manufacturer: str = ""
    excluded_sellers: Sequence[str] = ()
    excluded_staff: Sequence[str] = ()
    after: str = "2025-03-31"
    export_since: str = V.CUTOVER
    export_texts: Sequence[str] = ("store", "vin", "series", "team", "seller", "buyer", "finance_type", "mode")
    export_moneys: Sequence[str] = ("invoice_price", "settle_price", "sale_price", "gross", "unit_profit")
    soft_delete_flags: Mapping[str, str | Sequence[str]] = field(default_factory=dict)


def run_marts(spark: SparkSession, raw: Mapping[str, DataFrame], settings: MartSettings, out: str) -> DataFrame:
    """Build and publish all marts below ``out``; returns rows and outcome per table.

    ``raw`` holds the base tables under their names: sales, decoration, packages, cost,
    loans, bills, stock, sold, plan, orders, deals, unsold, void_orders, invoices,
    transfers, used_cars, and the dimensions series_dim and vat_rules.
    """
    raw = drop_soft_deleted(raw, settings.soft_delete_flags)
    series = raw["series_dim"]
    lines = written(
        accessories.settled(prefer_rows(raw["decoration"], "id", F.col("out_id") != 0)), "decoration"
    )
    gifts, paid = accessories.gifts(lines), accessories.paid(lines, settings.excluded_sellers)
    cost = written(finance.vehicle_cost(raw["cost"]), "cost")
    invoices = written(sales.latest_invoices(raw["invoices"]), "invoices")
    loose, traded = sales.used_car_parts(raw["used_cars"], invoices, settings.excluded_staff)
    profit = written(
        sales.sales_profit(
            sales.sales_detail(raw["sales"], series, settings.after), raw["vat_rules"], settings.companies,
            packages=accessories.packages(raw["packages"]), cost=cost, loans=finance.loans(raw["loans"]),
            gifts=gifts, invoices=invoices, used=traded, archive=raw.get("used_archive"), coupons=raw.get("coupons"),
        ),
        "profit",
    )
    booked = written(orders.orders(raw["orders"], raw["deals"], raw["unsold"], series), "orders")
    debits = written(finance.bills(raw["bills"], cost), "bills")
    inventory = stock.inventory(
        raw["stock"], raw["plan"], debits, series, settings.internal_companies, settings.manufacturer
    )
    homes = union_outer(raw["stock"], raw["sold"])
    moved = written(sales.transfers(raw["transfers"], profit), "transfers")
    final = sales.sales_final(profit, loose, moved, booked, homes, keep=written)
    vehicles = profit.groupBy("vin").agg(F.min("series").alias("series"))
    sold_items = written(left_lookup(paid, vehicles, ["vin"]), "accessories")
    documents = sales.export_tables(final, sold_items, settings.export_texts, settings.export_moneys, settings.export_since)
    tables = {
        "sales_data": final,
        "order_data": booked,
        "inventory_data": stock.published(inventory),
        "void_order_data": orders.void_orders(raw["void_orders"], series).distinct(),
        "debit_data": debits.distinct(),
        "sales_invoice_data": sales.sales_invoice(profit, booked).distinct(),
        "accessory_data": sold_items.distinct(),
        "sold_inventory": raw["sold"].distinct(),
    }
    loads = {n: (lambda df=df, n=n: write_replace(df, f"{out}/{n}")) for n, df in tables.items()}
    for name, df in zip(("sales", "accessories", "transfers"), documents):
        loads[f"documents_{name}"] = lambda df=df, name=name: write_documents(df, f"{out}/documents_{name}")
    return load_report(spark, loads)


@dataclass(frozen=True)
class DashboardSettings:
    """Where archive and current tables meet, the moment of the run, and names that differ from house to house."""

    as_of: datetime
    cutover: str = V.CUTOVER
    district: str = ""
    used_names: Mapping[str, str] = field(default_factory=dict)
    unsold_columns: Sequence[str] = ()
    unsold_names: Sequence[str] = ()
    split_series: tuple[str, float, str] | None = None


def _publish(spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]], out: str) -> DataFrame:
    """Write every table below ``out``; one that cannot be built is told in the report and stops no other."""
    return load_report(spark, {n: (lambda build=build, n=n: write_replace(build(), f"{out}/{n}")) for n, build in tables.items()})


def run_dashboards(spark: SparkSession, raw: Mapping[str, DataFrame], settings: DashboardSettings, out: str) -> DataFrame:
    """Build and publish the dashboard tables; returns rows and outcome per table.

    ``raw`` holds sales, orders, void_orders, stock, plan_dates, accessories, bills, used_cars and
    unsold with their ``*_archive`` tables where one exists, key_accounts, and the dimensions
    store_dim and series_dim. A table whose inputs are missing is reported as failed.
    """
    cut, series = settings.cutover, raw["series_dim"]

    def kept(build: Callable[[], DataFrame], name: str) -> Callable[[], DataFrame]:
        """A result that several tables use, written once, when it is first asked for."""
        held: list[DataFrame] = []

        def get() -> DataFrame:
            if not held:
                held.append(written(build(), name))
            return held[0]

        return get

    def split(df: DataFrame) -> DataFrame:
        return dashboard.renamed_series(df, *settings.split_series) if settings.split_series else df

    sold = kept(lambda: dashboard.sales(split(raw["sales"]), raw["sales_archive"], raw["store_dim"], cut), "dashboard-sales")
    booked = kept(lambda: dashboard.booked(raw["orders"], raw["orders_archive"], cut), "dashboard-orders")
    void = kept(lambda: dashboard.cancelled(raw["void_orders"], raw["void_orders_archive"], cut), "dashboard-void")
    tables = {
        "dashboard_sales": lambda: dashboard.finished_sales(sold(), series, settings.as_of),
        "dashboard_delivered": lambda: dashboard.delivered(raw["sales"], raw["delivered_archive"], raw["stock"], cut),
        "dashboard_orders": booked,
        "dashboard_cancelled": void,
        "dashboard_all_orders": lambda: dashboard.all_orders(booked().drop("buyer"), void()),
        "dashboard_stock": lambda: dashboard.with_key_account(dashboard.stock(raw["stock"], raw["plan_dates"]), raw["key_accounts"]),
        "dashboard_accessories": lambda: dashboard.accessories(
            raw["accessories"], raw["accessories_archive"], raw["store_dim"], series, settings.district, cut
        ),
        "dashboard_bills": lambda: dashboard.bills(raw["bills"], raw["bills_archive"], cut),
        "dashboard_used_cars": lambda: dashboard.used_cars(raw["used_cars"], raw["used_cars_archive"], dict(settings.used_names)),
        "dashboard_unsold": lambda: dashboard.unsold_locked(raw["unsold"], settings.unsold_columns, settings.unsold_names),
        "dashboard_tenure": lambda: dashboard.seller_tenure(sold()),
        "dashboard_catalogue": lambda: dashboard.catalogue([raw["sales"], raw["stock"], raw["parts"]]),
    }
    return _publish(spark, tables, out)


def run_app(
    spark: SparkSession, sales_data: DataFrame, inventory_data: DataFrame, out: str, since: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """Publish the tables of the application: in full, or what happened ``since`` a day.

    The short run puts the rows of its days in place of those published before, so running it
    twice changes nothing; a first run is always full. Returns the report and the summary.
    """

    def refreshed(df: DataFrame, path: str, at: str) -> DataFrame:
        if since is None or not exists(spark, path):
            return df
        recent = F.col(at) >= F.lit(since).cast("timestamp_ntz")
        return read_current(spark, path).where(F.coalesce(~recent, F.lit(True))).unionByName(df.where(recent), allowMissingColumns=True)

    sold, held = app.app_sales(sales_data), app.app_stock(inventory_data)
    paths = {n: f"{out}/app_{n}" for n in ("sales", "inventory")}
    loads = {
        "app_sales": lambda: write_replace(refreshed(sold, paths["sales"], "sale_date"), paths["sales"]),
        "app_inventory": lambda: write_replace(refreshed(held, paths["inventory"], "arrival_date"), paths["inventory"]),
    }
    report = load_report(spark, loads)
    return report, summary(read_current(spark, paths["sales"]), read_current(spark, paths["inventory"]), V.IN_STOCK)


@dataclass(frozen=True)
class LedgerSettings:
    """Columns, aliases and rule dates of the ledgers of products, film upgrades and scores."""

    store_alias: Mapping[str, str] = field(default_factory=dict)
    protection_columns: Sequence[str] = ()
    warranty_columns: Sequence[str] = ()
    excluded_sources: Sequence[str] = ()
    cutover: str = V.CUTOVER
    rule_date: str = V.TERMINAL_RULE_DATE


def run_ledgers(spark: SparkSession, raw: Mapping[str, DataFrame], settings: LedgerSettings, out: str) -> DataFrame:
    """Build and publish film upgrades, protection, insurance, warranty and cost tables; returns rows and outcome.

    ``raw`` holds film_push, film_sales, film_lines, shop_costs, protection_docs, protection_ledger,
    protection_prices, terminal, approvals, insurance, insurance_archive, warranty, marketing,
    salary, score_months, score_quarters and series_dim; what is missing is reported as failed.
    """
    names, series, rule = settings.store_alias, raw["series_dim"], settings.rule_date
    held: dict[str, DataFrame] = {}

    def protected() -> DataFrame:
        if "protection" not in held:
            sold = products.protection_sales(raw["protection_docs"], raw["terminal"], names, rule_date=rule)
            book = products.protection_ledger(raw["protection_ledger"], settings.protection_columns, names)
            held["protection"] = written(products.protection(sold, book, series, names, rule), "protection")
        return held["protection"]

    def labels() -> DataFrame:
        policies = products.insurance(raw["insurance_archive"], raw["insurance"], series, names, settings.cutover)
        return products.insurance_labels(policies, protected(), raw["approvals"], raw["terminal"], settings.excluded_sources, rule_date=rule)

    tables = {
        "film_funnel": lambda: film.funnel(raw["film_sales"], film.pushes(raw["film_push"], names), film.visits(raw["film_lines"]), raw["shop_costs"]),
        "film_ledger": lambda: film.ledger(raw["film_push"], names),
        "protection": protected,
        "protection_cost": lambda: products.protection_cost(raw["protection_docs"], raw["protection_prices"]),
        "insurance": labels,
        "warranty": lambda: products.warranty(raw["warranty"], settings.warranty_columns, names),
        "marketing_cost": lambda: costs.marketing_by_store(costs.marketing(raw["marketing"], names)),
        "salary_cost": lambda: costs.salary_by_store(raw["salary"]),
        "service_quality": lambda: scores.service_quality(
            scores.year_from_months(raw["score_months"], raw["score_quarters"], "2025"), scores.year_from_quarters(raw["score_quarters"], "2026")
        ),
    }
    return _publish(spark, tables, out)

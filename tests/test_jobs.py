"""The whole mart run over the derived business tables."""

from motorledger.plans.jobs import MartSettings, run_marts
from motorledger.queries import QUERIES
from motorledger.queries.registry import Tables
from motorledger.sources.sinks import read_current

FOLDER = "/root/testdata/sf0.001"


def test_all_marts_are_published(spark, tmp_path):
    t = Tables(spark, FOLDER)
    raw = {
        "sales": t.sales, "decoration": t.decoration, "packages": t.package_sales, "cost": t.vehicle_cost, "loans": t.loan_business,
        "bills": t.bill_business, "stock": t.stock, "sold": t.stock.where("invoice_date is not null"), "plan": t.plan, "orders": t.order_business,
        "deals": t.deals, "unsold": t.unsold, "void_orders": t.void_business, "invoices": t.invoices, "transfers": t.transfer_business,
        "used_cars": t.used_cars, "series_dim": t.series_dim, "vat_rules": t.vat_rules,
    }
    settings = MartSettings(["SISTER"], ["Customer#000000005"], "MAKER", ["S7"], ["B1", "B2"], "1996-12-31", "1998-01-01")
    report = {r["table_name"]: (r["result"], r["rows"]) for r in run_marts(spark, raw, settings, str(tmp_path)).collect()}
    assert len(report) == 11 and all(r[0] == "ok" and r[1] > 0 for r in report.values()), report
    mine = read_current(spark, f"{tmp_path}/sales_data")
    wanted = QUERIES["m11_sales_final"].run(spark, FOLDER)
    assert mine.select("vin", "store").distinct().count() == wanted.select("vin", "store").distinct().count()
    assert report["accessory_data"][1] == QUERIES["m1_paid_accessories"].run(spark, FOLDER).count()

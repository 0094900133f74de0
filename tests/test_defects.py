"""The choices made where the ledgers' old processing was wrong or undefined."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from motorledger import values as V
from motorledger.functions.dates import parse_ts
from motorledger.operators import documents, joins, keep, quality, unions
from motorledger.plans import accessories, app, dashboard, film, finance, orders, products, sales, scores, stock
from motorledger.sources import sinks, tables


def day(text):
    return datetime.strptime(text, "%Y-%m-%d")


def test_row_rules_really_run(spark):
    df = spark.createDataFrame([("f", 1, "14")], "file string, row int, month string")
    assert quality.check_rows(df, "file", "row", [quality.month_rule("month")]).count() == 1


def test_header_error_counts_once(spark):
    headers = quality.check_headers(spark, "f", ["a", "x"], ["a", "b", "c"])
    empty = quality.check_rows(spark.createDataFrame([("f", 1, "2")], "file string, row int, month string"), "file", "row", [quality.month_rule("month")])
    out = quality.quality_summary(spark.createDataFrame([("f", 1)], "file string, row int"), empty, headers, "file").first()
    assert (out["files"], out["header_errors"], out["data_errors"], out["error_rate"]) == (1, 1, 0, 0.0)


def test_only_extra_headers_are_reported(spark, rows):
    assert rows(quality.check_headers(spark, "f", ["a", "x"], ["a"])) == [("f", "extra", "x")]


def test_invoice_table_drops_unknown_teams(spark, rows):
    profit = spark.createDataFrame([("v1", "调拨", day("2025-05-01")), ("v2", "", day("2025-05-01")), ("v3", None, day("2025-05-01")), ("v4", "G", day("2025-05-01"))], "vin string, team string, sale_date timestamp_ntz")
    ids = spark.createDataFrame([("v4", "old", day("2025-01-01")), ("v4", "new", day("2025-02-01"))], "vin string, id_number string, order_date timestamp_ntz")
    assert rows(sales.sales_invoice(profit, ids), "vin", "id_number") == [("v4", "new")]


def test_store_alias_is_applied(spark, rows):
    ledger = spark.createDataFrame([("S", "2025/1/2", "300", "x")], "store string, push_date string, commission string, gift string").withColumn("vin", F.lit("V"))
    assert rows(film.pushes(ledger, {"S": "T"}), "store", "commission") == [("T", 100.0)]


def test_film_uses_the_latest_push_and_the_gift_rule_flag(spark, rows):
    ledger = spark.createDataFrame(
        [("V000001", "2025/1/2", "300", "x"), ("W000001", "2025/3/2", "0", "x"), ("V000002", "bad", "1", None)],
        "vin string, push_date string, commission string, gift string",
    ).withColumn("store", F.lit("S"))
    sold = spark.createDataFrame([("X000001", "S", "膜", day("2025-01-01")), ("X000009", "S", None, day("2025-01-01")), (V.USED_CAR, "S", None, None)], "vin string, store string, gift_items string, sale_date timestamp_ntz")
    fitted = film.visits(
        spark.createDataFrame([("X000001", "膜A", None, day("2025-03-05"), 10.0, 0.0, "S"), ("X000001", "垫", "已退货", day("2025-03-01"), 9.0, 5.0, "S")], "vin string, item string, item_state string, receipt_date timestamp_ntz, cost double, revenue double, store string").withColumn("seller", F.lit("p"))
    )
    costs = film.store_costs(
        spark.createDataFrame([("S", "2025", "3", "100", None, "x", None, None), ("S", "2025", None, "1", None, None, None, None)], "store string, year string, month string, staff string, rent string, washing string, supplies string, repair string"),
        ["S"], {},
    )
    out = film.funnel(sold, film.pushes(ledger, {}), fitted, costs)
    got = rows(out, "vin", "commission", "shop_cost", "gift_film", "pushed", "visited", "free_film", "within_90_days")
    assert got == [("X000001", -200.0, 100.0, "是", "是", "是", "是", "是"), ("X000009", None, None, "否", "否", "否", "未到店", "否")]
    arrived = ledger.withColumn("arrival_date", F.lit(None).cast("string"))
    assert rows(film.ledger(arrived, {}), "store_commission") == [(0.0,), (1.0,), (100.0,)]


def test_midnight_of_the_cutover_is_kept(spark, rows):
    df = spark.createDataFrame([("v", day("2025-04-01"), V.APPROVED, None, "m")], "vin string, order_date timestamp_ntz, approval string, trim string, model string")
    assert rows(dashboard.booked(df, df.drop("approval")), "vin", "approval", "trim") == [("v", V.APPROVED, "m")]


def test_a_district_in_the_archive_is_not_doubled(spark):
    current = spark.createDataFrame([], "store string, series string, first_receipt string")
    archive = spark.createDataFrame([("S", "A", "2025/1/1"), ("S", "A", "2025/6/1"), ("T", "A", "2025/6/1")], "store string, series string, sold_date string")
    stores = spark.createDataFrame([("S", "x"), ("T", "y")], "store string, district string")
    series = spark.createDataFrame([("A", "N")], "series string, network string")
    assert dashboard.accessories(current, archive, stores, series, "x").count() == 2


def test_lead_days_fill_from_the_ship_date(spark, rows):
    now = spark.createDataFrame([("P1", 10, "在库", "2025/1/10", "2025/1/5"), ("P2", 10, "在库", "2025/1/10", "2025/1/5"), ("P3", 10, "在库", None, "2025/1/5")], "purchase_no string, stock_days int, vehicle_status string, arrival_date string, shipped_date string")
    plans = spark.createDataFrame([("P1", None, None, "2025-01-09")], "purchase_no string, service_no string, change_no string, plan_date string")
    assert rows(dashboard.stock(now, plans), "purchase_no", "lead_days") == [("P1", 2), ("P2", 6), ("P3", None)]


def profit_inputs(spark):
    sold = spark.createDataFrame(
        [("v1", "贵州店", "S", "M", "G", "按揭", "Customer name", day("2025-05-01"), 1000.0, 800.0, 100.0), ("v2", "X", "S", "M", "调拨", "全款", "B1", day("2025-05-01"), 1000.0, 900.0, 0.0)],
        "vin string, store string, series string, model string, team string, mode string, buyer string, sale_date timestamp_ntz, invoice_price double, settle_price double, trade_in double",
    )
    for c in ["voucher", "finance_deposit", "insurance_deposit", "other_deposit", "ticket_amt", "ticket_fee", "plate_fee"]:
        sold = sold.withColumn(c, F.lit(10.0) if c != "ticket_fee" else F.lit(0.0))
    sold = sold.withColumn("advisor_fee", F.lit(50.0)).withColumn("transfer_fee", F.when(F.col("vin") == "v2", F.lit("30")))
    rules = spark.createDataFrame([("SM", "900", "100", "2025-01-01"), ("SM", "900", "200", "2025-04-01"), ("SM", "900", "999", "2026-01-01")], "match_key string, cap_price string, deduction string, start_date string")
    loans = finance.loans(spark.createDataFrame([("v1", "厂家贴息", "p", "12期", "5%", "1,000", "500", "113", "226", "0", "0", "a"), ("v2", None, "建行5免2", "12", "x", "1", "1", "9", "9", "9", "9", "a")], "vin string, finance_channel string, finance_plan string, term string, rebate_rate string, invoice_price string, loan_amount string, finance_rebate string, factory_subsidy string, dealer_subsidy string, finance_fee string, fee_status string"))
    return sold, rules, loans


def test_profit_identity_and_one_tax_rule_per_sale(spark):
    sold, rules, loans = profit_inputs(spark)
    out = sales.sales_profit(sold, rules, [], loans=loans)
    got = {r["vin"]: r for r in out.collect()}
    assert len(got) == 2
    a, b = got["v1"], got["v2"]
    assert a["vat_margin"] == 300.0 and a["tax"] == round(100 / 1.13 * 0.13 * 1.12, 2)
    assert a["promo_cost"] == 240.0 and b["promo_cost"] == 40.0
    assert a["finance_type"] == V.LOAN_SUBSIDISED and b["finance_type"] == V.CASH
    assert a["finance_fee"] == 50.0 and b["plate_fee"] == 60.0 and b["transfer_kind"] == V.INTERNAL_OUT
    for r in got.values():
        plus = sum(r[c] for c in sales.PROFIT_PLUS)
        minus = sum(r[c] for c in sales.PROFIT_MINUS)
        assert abs(r["unit_profit"] - (plus - minus - r["transfer_fee"])) < 1e-9
    assert b["transfer_fee"] == 30.0


def test_loans_classes_and_money(spark, rows):
    _, _, loans = profit_inputs(spark)
    got = rows(loans, "vin", "finance_type", "term", "rebate_rate", "down_payment")
    assert got == [("v1", V.LOAN_SUBSIDISED, "12", 0.05, 500.0), ("v2", V.LOAN_ZERO, "12", 0.0, 0.0)]


def test_used_cars_split(spark, rows):
    used = spark.createDataFrame(
        [("S", "1", "5", "a", "b1", "m", "2025/1/1", None, V.RECEIVED), ("S", "1", "6", "a", "b2", "m", "2025/1/2", "v1", V.RECEIVED), ("S", "1", "7", "a", "b3", "m", "2025/1/3", "v9", V.RECEIVED), ("S", "1", "8", "a", "no", "m", None, "", V.RECEIVED), ("S", "1", "9", "a", "b5", "m", None, None, "x")],
        "store string, deal_price string, other_fee string, lead_by string, buyer string, model string, receipt_date string, trade_in_vin string, receipt_state string",
    )
    invoices = spark.createDataFrame([("v1", V.VEHICLE_SALE_DOC, "2025/1/1", "S")], "vin string, doc_kind string, download_time string, invoice_store string")
    loose, traded = sales.used_car_parts(used, sales.latest_invoices(invoices), ["no"])
    assert rows(loose, "buyer", "vin", "unit_profit") == [("b1", V.USED_CAR, 5.0), ("b3", V.USED_CAR, 7.0)]
    assert rows(traded, "vin", "used_rebate_1") == [("v1", 6.0), ("v9", 7.0)]


def test_orders_and_void_orders(spark, rows):
    book = spark.createDataFrame([("v1", "1380", None, "n", "S", "X", day("2025-01-05"), None, "x", 10.0, False), ("v2", "1380", None, "n", "S", "X", None, day("2025-01-01"), V.AWAITING, 10.0, False), ("v3", "1", None, "n", "S", "X", None, None, None, 1.0, True)],
        "vin string, phone1 string, phone2 string, buyer string, series string, store string, sale_date timestamp_ntz, deposit_date timestamp_ntz, deposit_state string, deposit double, voided boolean")
    hosts = spark.createDataFrame([(1, "1380.0", "0", "h2", "S", "n", "X"), (2, "1380", "", "h1", "S", "n", "X")], "id int, phone1 string, phone2 string, host string, series string, buyer string, order_store string")
    series = spark.createDataFrame([("Z", "N")], "series string, network string")
    got = rows(orders.orders(book, hosts, hosts.limit(0), series), "vin", "host", "cash_and_carry", "deposit")
    assert got == [("v1", "h1", V.CASH_AND_CARRY, 3000.0), ("v2", "h1", None, 10.0)]
    void = spark.createDataFrame([("a", "重复录入", "2025/1/1", "2025/1/2"), ("b", None, "2025/1/1", "2025/1/2"), ("c", "x", "2025/1/1", None)], "buyer string, void_type string, order_date string, void_date string").withColumns({"store": F.lit("S"), "series": F.lit("Z")})
    assert rows(orders.void_orders(void, series), "buyer", "not_counted") == [("b", 0), ("c", 1)]


def test_protection_rules(spark, rows):
    docs = spark.createDataFrame(
        [("v1", "2026/2/28", "2026/3/5", "10", "4"), ("v2", "2026/3/1", None, "10", "4"), ("v3", "2026/3/2", "2025/1/1", "10", "x")],
        "vin string, product_sale_date string, invoice_date string, product_amount string, cost string",
    ).withColumns({"validity": F.lit(V.VALID), "department": F.lit(V.PRE_SALES), "store": F.lit("贵州店"), "series": F.lit("S"), "network": F.lit("N"), "version": F.lit("畅行+")})
    terminal = spark.createDataFrame([("v3",)], "vin string")
    sold = products.protection_sales(docs, terminal, {})
    assert rows(sold, "vin", "profit", "date") == [("v1", 6.0, day("2026-03-05")), ("v3", None, day("2026-03-02"))]
    both = products.protection(sold, products.protection_ledger(docs.limit(0).withColumn("sale_date", F.col("invoice_date")), ["vin", "sale_date", "invoice_date", "store", "series"], {}), spark.createDataFrame([], "series string, network string"), {})
    assert rows(both, "vin", "city", "within_3_months", "after_rule_date") == [("v1", "贵州", "是", "否"), ("v3", "贵州", "否", "是")]


def test_insurance_labels_follow_their_date(spark, rows):
    policies = spark.createDataFrame([("v1", "鼎和", "1", day("2026-01-01")), ("v2", "A", "1000", None), ("v3", "A", "950", day("2026-03-01")), ("v4", "鼎和", "1", day("2026-01-01"))], "vin string, insurer string, compulsory_premium string, date timestamp_ntz").withColumns({"store": F.lit(None).cast("string"), "business_source": F.lit("x")})
    one = lambda *v: spark.createDataFrame([(x,) for x in v], "vin string")
    out = products.insurance_labels(policies, one("v4"), one("v2", "v3"), one("v3"))
    assert rows(out, "vin", "protected", "rule_label", "city") == [("v1", "否", V.NOT_COMPLIANT, "成都"), ("v2", "否", V.NOT_COMPLIANT, "成都"), ("v3", "否", V.COMPLIANT, "成都"), ("v4", "是", V.COMPLIANT, "成都")]
    assert rows(products.insurance_labels(policies, one("v4"), one(), one(), drop_excluded=True), "vin") == [("v3",), ("v4",)]


def test_quarters_from_months(spark, rows):
    cols = {"m1_score": "8", "m2_score": None, "m3_score": "9.01", "m2_incentive": "x", "m3_incentive": "5"}
    months = spark.createDataFrame([("S",)], "store string").withColumns(
        {c: F.lit(cols.get(c)).cast("string") for q in scores.QUARTER_MONTHS.values() for part in q.values() for c in part}
    )
    sheet = spark.createDataFrame([("S", "7", "ok", "免考核", "6.5", "good", "-200")], "store string, q3_score string, q3_result string, q3_incentive string, q4_score string, q4_result string, q4_incentive string")
    got = rows(scores.year_from_months(months, sheet, "2025"))
    assert got == [("S", "2025Q1", 8.5, None, 5.0), ("S", "2025Q2", 0.0, None, 0.0), ("S", "2025Q3", 7.0, "ok", 0.0), ("S", "2025Q4", 6.5, "good", -200.0)]


def test_app_tables_drop_text_nan(spark, rows):
    raw = spark.createDataFrame([(" v1 ", "G", "1,000"), ("nan", "G", "1"), (None, "G", "1"), ("v2", "试驾", "1"), ("v3", None, "x")], "vin string, team string, sale_price string")
    assert rows(app.app_sales(raw), "vin", "sale_price") == [("v1", 1000.0), ("v3", 0.0)]


def test_inventory_sources(spark, rows):
    now = spark.createDataFrame([("P1", "X", "SIS", "S", "")], "purchase_no string, store string, supplier string, series string, invoice_date string")
    plan = spark.createDataFrame([("P2", V.HOST_STORE, "OUT", "S"), ("P3", "X", "MAKER", "S")], "purchase_no string, store string, supplier string, series string")
    bills = spark.createDataFrame([("P2", "光大", "2025-01-01")], "purchase_no string, bank string, issue_date string")
    out = stock.inventory(now, plan, bills, spark.createDataFrame([("S", "N")], "series string, network string"), ["SIS"], "MAKER")
    got = rows(out, "purchase_no", "store", "source_kind", "certificate")
    assert got == [("P1", "X", V.INTERNAL_IN, None), ("P2", "N-直播基地", V.EXTERNAL_IN, "光大"), ("P3", "X", None, "公司")]
    assert stock.published(out).count() == 3


def test_same_result_for_any_partitioning(spark, rows):
    lines = spark.createDataFrame(
        [("v1", f"N{i % 2}", "其他", 5.0 * i, 2.0, 1.0, 1.0, "垫" if i % 2 else "膜", "s1", "S", "b", "p", day(f"2025-01-0{1 + i % 9}"), None) for i in range(12)],
        "vin string, order_no string, doc_type string, revenue double, cost double, labour_fee double, qty double, item string, seller string, store string, buyer string, phone1 string, receipt_date timestamp_ntz, invoice_date timestamp_ntz",
    )
    first = rows(accessories.paid(lines.repartition(1)))
    assert rows(accessories.paid(lines.repartition(9))) == first and len(first) == 1


def test_union_distinct_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1)], "a string, b int")
    assert unions.union_distinct(df, df).count() == 1


def test_long_ids_stay_whole(spark):
    from pyspark.sql import types as T

    from motorledger.operators.columns import conform

    df = spark.createDataFrame([("1234567890123456789",), ("99999999999999999999",), ("12.0",)], "id string")
    got = conform(df, T.StructType([T.StructField("id", T.LongType())])).collect()
    assert [r["id"] for r in got] == [1234567890123456789, None, None]


def test_amounts_that_do_not_fit_raise(spark):
    import pytest

    from motorledger.operators.columns import conform_money

    df = spark.createDataFrame([(250_000_000.0,), (None,), (float("nan"),)], "weight double")
    with pytest.raises(Exception, match="does not fit"):
        conform_money(df, ["price"]).collect()
    assert [r[0] is None for r in conform_money(df, ["weight"]).collect()] == [False, True, True]


def test_unions_keep_decimals(spark):
    from motorledger.operators.unions import union_outer

    wide, narrow = spark.sql("select cast(1 as decimal(18,2)) as x"), spark.sql("select cast(2 as decimal(10,4)) as x")
    assert union_outer(wide, narrow).schema["x"].dataType.simpleString() == "decimal(20,4)"


def test_asof_rows_without_time_or_key_match_nothing(spark, rows):
    left = spark.createDataFrame([("a", None, 1), (None, day("1960-05-01"), 2), ("a", day("1960-05-01"), 3), ("a", day("1890-01-01"), 4)], "k string, ts timestamp_ntz, n int")
    rules = spark.createDataFrame([("a", day("1900-01-01"), "r")], "k string, start timestamp_ntz, rule string")
    for days in (1, 0.25):
        assert rows(joins.asof_lookup(left, rules, ["k"], "ts", "start", ["rule"], days), "n", "rule") == [(1, None), (2, None), (3, "r"), (4, None)]


def test_interval_rows_without_time_or_key_match_nothing(spark, rows):
    left = spark.createDataFrame([("a", None, 1), (None, day("2024-05-01"), 2), ("a", day("2024-05-01"), 3)], "k string, ts timestamp_ntz, n int")
    rules = spark.createDataFrame([("a", day("1900-01-01"), day("2090-01-01"), "r")], "k string, s timestamp_ntz, e timestamp_ntz, rule string")
    assert rows(joins.interval_join(left, rules, ["k"], "ts", "s", "e", ["rule"]), "n", "rule") == [(1, None), (2, None), (3, "r")]


def test_a_keyed_table_refuses_another_bucket_count(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.create_keyed(spark.range(50), path, "id", 16)
    with pytest.raises(ValueError, match="16"):
        sinks.upsert_table(spark.range(50), path, "id")
    with pytest.raises(ValueError, match="16"):
        sinks.delete_rows(spark, path, spark.createDataFrame([("1",)], "_id string"), "id", "id")
    sinks.upsert_table(spark.range(60), path, "id", buckets=16)
    assert sinks.read_keyed(spark, path).count() == 60


def test_lists_of_any_length_are_read_alike(spark):
    df = spark.range(1000)
    assert tables.scan_in(df, {"id": ["1", "2", "5000"]}).count() == 2
    assert tables.scan_in(df, {"id": [str(i) for i in range(300)]}).count() == 300


def test_more_date_forms(spark):
    forms = ["2024.01.05", "01/05/2024", "20240105 10:00:00", "Jan 5 2024", "January 5, 2024", "13/01/2024", "Jan 2024", "2024.13.05", "20240105", "4 Jan"]
    got = [r[0] for r in spark.createDataFrame([(f,) for f in forms], "t string").select(parse_ts("t")).collect()]
    five = day("2024-01-05")
    assert got == [five, five, five.replace(hour=10), five, five, day("2024-01-13"), None, None, five, None]


def test_many_copies_are_allocated_once(spark, monkeypatch):
    monkeypatch.setattr(keep, "_RUN", 7)
    df = spark.createDataFrame([("a", 1, 5.0)] * 50 + [("a", 2, 5.0)] * 3 + [(None, None, 4.0)] * 8, "k string, n int, cost double")
    out = keep.allocate_once(df.repartition(5), ["k"], "cost", ["n"])
    assert out.groupBy("k").agg(F.sum("cost").alias("s"), F.count("*").alias("c")).orderBy("k").collect() == [(None, 4.0, 8), ("a", 5.0, 53)]


def test_collected_values_are_whole_and_in_order(spark):
    deep = '{"id": {"id": [1, {"id": "a,}\\"b"}], "x": 2}, "x" : [ ], "y": [{"x": 2}, "id", ":"], "z": 1.50}'
    got = spark.createDataFrame([(deep,), (None,), ("{}",), ('{"id":',)], "t string").select(documents.collect_json_keys("t", ["id", "x", "z"])).collect()
    inner = '"a,}\\"b"'
    ids = f'[{{"id":[1,{{"id":{inner}}}],"x":2}},[1,{{"id":{inner}}}],{inner}]'
    assert [r[0] for r in got] == [{"id": ids, "x": "[2,[],2]", "z": "1.50"}, {}, {}, {}]

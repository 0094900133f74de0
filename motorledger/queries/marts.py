"""Business marts over the derived business tables."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorledger import values as V
from motorledger.operators.rows import prefer_rows
from motorledger.plans import accessories, app, costs, dashboard, film, finance, orders, products, sales, scores, stock
from motorledger.queries.registry import QUERIES, Tables, query
from motorledger.queries.shapes import monthly_wide
from motorledger.session import shared_folder, written
from motorledger.sources.ledgers import read_ledger_dir
from motorledger.sources.tables import read_documents

DAY = "yyyy-MM-dd"
CUT = "1998-01-01"
ALIAS = {"NATION_3": "NATION_4"}


def day_texts(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, DAY) for c in cols})


def cents(df: DataFrame, *cols: str) -> DataFrame:
    # adding 0 turns a negative zero into a plain one
    return df.withColumns({c: F.round(c, 2) + F.lit(0.0) for c in cols})


# -- SQL of the marts, as pieces that later marts build on ------------------------------

GIFT_LINES = """
    pref AS (SELECT * FROM (SELECT *, max(out_id <> 0) OVER (PARTITION BY id) AS has_out FROM {decoration})
             WHERE out_id <> 0 OR NOT has_out),
    lines AS (SELECT *, doc_type = '新车销售' OR (doc_type IN ('客户增购', '换货销售', '独立销售') AND revenue = 0) AS gift FROM pref
              WHERE receipt_date IS NOT NULL
                AND (item_state IS NULL OR item_state NOT IN ('已退款', '已退货', '已换货', '全退款', '全退货', '部分退款'))),
    gifts AS (SELECT vin, sum(cost + labour_fee) AS gift_cost, round(sum(revenue), 2) AS gift_revenue, string_agg(item, ',' ORDER BY item) AS gift_items
              FROM lines WHERE gift AND vin IS NOT NULL GROUP BY vin)"""
PACKAGES = """
    packages AS (SELECT vin, coalesce(sum(try_cast(settle_cost AS double)), 0) AS maintenance_cost,
                        string_agg(concat(package, '*', times), ',' ORDER BY concat(package, '*', times)) AS package_items
                 FROM {package_sales} WHERE package <> '保赔无忧' AND (approval IS NULL OR approval <> '审批驳回')
                   AND (order_state IS NULL OR order_state NOT IN ('已退卡', '已登记')) AND try_cast(amount AS double) <= 0 GROUP BY vin)"""
COST = """
    cost AS (SELECT * REPLACE (try_cast(replace(referral, ',', '') AS double) AS referral) FROM (
               SELECT *, row_number() OVER (PARTITION BY vin ORDER BY op_date DESC, store, purchase_no, vehicle_status NULLS LAST, try_cast(replace(referral, ',', '') AS double),
                      adjustment, gov_subsidy, insurance_rebate, terminal_rebate, plate_cost, other_cost, tie) AS rn FROM {vehicle_cost}) WHERE rn = 1)"""
LOANS = """
    loans AS (SELECT *, invoice_price - loan_amount AS down_payment, fs / 1.13::double * 0.13::double * 1.12::double + rebate / 1.06::double * 0.06::double * 1.12::double AS finance_tax,
                     rebate - dealer_subsidy - (fs / 1.13::double * 0.13::double * 1.12::double + rebate / 1.06::double * 0.06::double * 1.12::double) AS finance_profit
              FROM (SELECT * EXCLUDE (term, rebate_rate), replace(term, '期', '') AS term, try_cast(replace(rebate_rate, '%', '') AS double) / 100 AS rebate_rate,
                      factory_subsidy AS fs, try_cast(replace(finance_rebate, ',', '') AS double) AS rebate,
                      CASE WHEN contains(finance_channel, '非贴息') THEN '厂家非贴息贷' WHEN contains(finance_channel, '贴息') THEN '厂家贴息贷'
                           WHEN finance_plan IN ('交行信用卡中心5免2-9%', '建行5免2') THEN '无息贷' ELSE '非贴息贷' END AS finance_type FROM {loan_business}))"""
INVOICE = """
    invoice AS (SELECT vin, invoice_store FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY download_time DESC, doc_kind, invoice_store) AS rn
                FROM {invoices} WHERE doc_kind = '车辆销售单') WHERE rn = 1)"""
USED = """
    received AS (SELECT * FROM {used_cars} WHERE receipt_state = '已收款'),
    traded AS (SELECT * FROM (SELECT trade_in_vin AS vin, deal_price AS used_price, cast(other_fee AS double) AS used_rebate_1, receipt_date,
                 row_number() OVER (PARTITION BY trade_in_vin ORDER BY receipt_date DESC, deal_price, cast(other_fee AS double)) AS rn
               FROM received WHERE trade_in_vin <> '') WHERE rn = 1),
    loose AS (SELECT store, deal_price AS used_price, cast(other_fee AS double) AS used_rebate, lead_by AS seller, buyer, model, receipt_date
              FROM received LEFT JOIN (SELECT vin AS inv_vin, invoice_store FROM invoice) ON inv_vin = trade_in_vin
              WHERE (invoice_store IS NULL OR trade_in_vin IS NULL OR trade_in_vin = '') AND (buyer IS NULL OR buyer NOT IN ('B1', 'B2')))"""
VAT = """
    rules AS (SELECT match_key, try_cast(cap_price AS double) AS cap, try_cast(deduction AS double) AS deduction,
                     coalesce(try_strptime(replace(start_date, '/', '-'), '%Y-%m-%d'), TIMESTAMP '1900-01-01') AS from_day FROM {vat_rules})"""
PROFIT = f"""{GIFT_LINES}, {PACKAGES}, {COST}, {LOANS}, {INVOICE}, {USED}, {VAT},
    detail AS (SELECT s.* EXCLUDE (store), CASE WHEN s.store = '直播基地' AND d.network IS NOT NULL THEN concat(d.network, '-', s.store) ELSE s.store END AS store, d.network
               FROM {{sales}} s LEFT JOIN {{series_dim}} d ON d.series = s.series WHERE s.sale_date > '1996-12-31'),
    wide AS (SELECT s.*, mode IS NOT DISTINCT FROM '全款' AS cash, coalesce(p.maintenance_cost, 0) AS maintenance_cost, coalesce(c.adjustment, 0) AS adjustment,
               coalesce(c.referral, 0) AS referral, coalesce(c.gov_subsidy, 0) AS gov_subsidy, coalesce(c.insurance_rebate, 0) AS insurance_rebate,
               coalesce(c.terminal_rebate, 0) AS terminal_rebate, coalesce(c.plate_cost, 0) AS plate_cost, coalesce(c.other_cost, 0) AS other_cost,
               CASE WHEN mode IS DISTINCT FROM '全款' THEN coalesce(l.finance_fee, 0) ELSE 0 END AS loan_fee,
               CASE WHEN mode IS DISTINCT FROM '全款' THEN coalesce(l.finance_profit, 0) ELSE 0 END AS loan_profit,
               l.finance_type AS loan_type, coalesce(g.gift_cost, 0) AS gift_cost, coalesce(g.gift_revenue, 0) AS gift_revenue,
               g.gift_items, p.package_items, i.invoice_store, u.used_rebate_1, u.receipt_date, coalesce(transfer_fee, 0) AS fee,
               (SELECT max({{{{'f': from_day, 'c': cap, 'd': deduction}}}}) FROM rules r WHERE r.match_key = concat(s.series, s.model) AND r.from_day <= s.sale_date) AS rule
             FROM detail s LEFT JOIN packages p ON p.vin = s.vin LEFT JOIN cost c ON c.vin = s.vin LEFT JOIN loans l ON l.vin = s.vin
               LEFT JOIN gifts g ON g.vin = s.vin LEFT JOIN invoice i ON i.vin = s.vin LEFT JOIN traded u ON u.vin = s.vin),
    margin AS (SELECT *, terminal_rebate + insurance_rebate AS rebate_total,
               invoice_price + trade_in + terminal_rebate + insurance_rebate - settle_price - CASE WHEN ticket_fee > 0 THEN ticket_amt ELSE 0 END AS vat_margin,
               voucher + finance_deposit + insurance_deposit AS cash_back, gift_cost + maintenance_cost AS gift_total,
               coalesce(used_rebate_1, 0) AS used_rebate, CASE WHEN round(loan_fee, 10) = 0 AND NOT cash THEN advisor_fee ELSE loan_fee END AS finance_fee FROM wide),
    taxed AS (SELECT *, vat_margin - CASE WHEN settle_price <= rule.c AND trade_in > 0 THEN rule.d ELSE 0 END AS base,
               invoice_price + trade_in + cash_back - ticket_amt AS sale_price, loan_profit + finance_fee AS finance_profit,
               plate_fee + CASE WHEN advisor_fee > 0 AND cash THEN advisor_fee ELSE 0 END + plate_cost AS plate_profit,
               cash_back + CASE WHEN contains(store, '贵州') AND team IS DISTINCT FROM '调拨' THEN 200 ELSE 0 END AS promo_cost FROM margin),
    taxes AS (SELECT *, CASE WHEN base > 0 THEN round_even(base / 1.13::double * 0.13::double * 1.12::double, 2) ELSE 0 END AS tax FROM taxed),
    profit AS (SELECT *, sale_price + rebate_total - tax - settle_price AS gross,
               CASE WHEN team = '调拨' THEN CASE WHEN buyer IN ('Customer#000000005') OR length(buyer) <= 5 THEN '内部调出' ELSE '外部调出' END END AS transfer_kind,
               sale_price + rebate_total - tax - settle_price + finance_profit + plate_profit + used_rebate + referral + other_cost + gov_subsidy + gift_revenue
                 + adjustment + other_fee - promo_cost - gift_total - fee AS unit_profit,
               CASE WHEN cash THEN '全款' ELSE loan_type END AS finance_type FROM taxes)"""
PROFIT = PROFIT.replace("{{{{", "{").replace("}}}}", "}").replace("{{", "{").replace("}}", "}")


def decoration_lines(t: Tables) -> DataFrame:
    return accessories.settled(prefer_rows(t.decoration, "id", F.col("out_id") != 0))


def used_parts(t: Tables):
    return sales.used_car_parts(t.used_cars, sales.latest_invoices(t.invoices), ["B1", "B2"])


def profit_of(t: Tables) -> DataFrame:
    detail = sales.sales_detail(t.sales, t.series_dim, "1996-12-31")
    return sales.sales_profit(
        detail, t.vat_rules, ["Customer#000000005"],
        packages=accessories.packages(t.package_sales), cost=finance.vehicle_cost(t.vehicle_cost),
        loans=finance.loans(t.loan_business), gifts=accessories.gifts(decoration_lines(t)),
        invoices=sales.latest_invoices(t.invoices), used=used_parts(t)[1],
    )


@query("m1_gifts", f"WITH {GIFT_LINES} SELECT vin, gift_cost, gift_revenue, gift_items FROM gifts")
def _(t: Tables):
    return cents(accessories.gifts(decoration_lines(t)), "gift_revenue")


@query(
    "m1_paid_accessories",
    f"""WITH {GIFT_LINES},
        paid AS (SELECT *, cost + labour_fee AS full_cost FROM lines WHERE NOT gift AND (seller IS NULL OR seller NOT IN ('S7'))),
        texts AS (SELECT order_no, string_agg(concat(item, '*', qty::bigint), ',' ORDER BY concat(item, '*', qty::bigint)) AS order_items FROM paid GROUP BY order_no),
        grouped AS (SELECT vin, seller, string_agg(DISTINCT doc_type, ',' ORDER BY doc_type) AS doc_types,
               string_agg(DISTINCT strftime(invoice_date, '%Y/%m/%d'), ',' ORDER BY strftime(invoice_date, '%Y/%m/%d')) AS invoice_dates,
               string_agg(DISTINCT strftime(receipt_date, '%Y/%m/%d'), ',' ORDER BY strftime(receipt_date, '%Y/%m/%d')) AS receipt_dates,
               strftime(min(receipt_date), '%Y/%m/%d') AS first_receipt, min_by(store, (receipt_date, store)) AS store,
               min_by(buyer, (receipt_date, buyer)) AS buyer, min_by(phone1, (receipt_date, phone1)) AS phone1,
               string_agg(DISTINCT order_items, ',' ORDER BY order_items) AS items, sum(revenue) AS revenue, sum(full_cost) AS cost, sum(qty) AS qty
             FROM paid JOIN texts USING (order_no) WHERE vin IS NOT NULL AND seller IS NOT NULL GROUP BY vin, seller)
        SELECT * REPLACE (round(revenue, 2) AS revenue), round(revenue - cost, 2) AS profit FROM grouped""",
)
def _(t: Tables):
    return cents(accessories.paid(decoration_lines(t), ["S7"]), "revenue", "profit")


@query(
    "m2_vehicle_cost",
    f"WITH {COST} SELECT vin, store, purchase_no, vehicle_status, referral, adjustment, gov_subsidy, insurance_rebate, terminal_rebate, plate_cost, other_cost, strftime(op_date, '%Y-%m-%d') AS op_date FROM cost",
)
def _(t: Tables):
    return day_texts(finance.vehicle_cost(t.vehicle_cost), "op_date")


@query("m3_packages", f"WITH {PACKAGES} SELECT * FROM packages")
def _(t: Tables):
    return accessories.packages(t.package_sales)


@query(
    "m4_loans",
    f"WITH {LOANS} SELECT vin, finance_type, term, rebate_rate, down_payment, rebate AS finance_rebate, round(finance_tax, 4) AS finance_tax, round(finance_profit, 4) AS finance_profit FROM loans",
)
def _(t: Tables):
    out = finance.loans(t.loan_business)
    return out.select(
        "vin", "finance_type", "term", "rebate_rate", "down_payment", "finance_rebate",
        F.round("finance_tax", 4).alias("finance_tax"), F.round("finance_profit", 4).alias("finance_profit"),
    )


BILLS = f"""{COST}, states AS (SELECT purchase_no, vehicle_status FROM (SELECT *, row_number() OVER (PARTITION BY purchase_no ORDER BY op_date DESC, vehicle_status NULLS LAST) AS place
              FROM cost) WHERE place = 1),
    bills AS (SELECT b.*, CASE WHEN cleared = '已清' THEN 1 ELSE 0 END AS redeemed, coalesce(s.vehicle_status, '未发') AS vehicle_status
              FROM {{bill_business}} b LEFT JOIN states s ON s.purchase_no = b.purchase_no)"""


def bills_of(t: Tables) -> DataFrame:
    return finance.bills(t.bill_business, finance.vehicle_cost(t.vehicle_cost))


@query("m5_bills", f"WITH {BILLS} SELECT purchase_no, vin, bill_no, bill_store, bank, cleared, redeemed, vehicle_status FROM bills")
def _(t: Tables):
    return bills_of(t).select("purchase_no", "vin", "bill_no", "bill_store", "bank", "cleared", "redeemed", "vehicle_status")


INVENTORY = f"""{BILLS},
    plan_bills AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY purchase_no ORDER BY issue_date DESC, bank NULLS LAST, bill_store, due_date) AS rn FROM bills) WHERE rn = 1),
    planned AS (SELECT p.*, coalesce(b.bank, '公司') AS certificate, b.bill_store FROM {{plan}} p LEFT JOIN plan_bills b ON b.purchase_no = p.purchase_no),
    both_kinds AS (SELECT purchase_no, vin, NULL AS plan_id, store, supplier, series, model, vehicle_status, invoice_date, NULL AS certificate, NULL AS bill_store FROM {{stock}}
             UNION ALL SELECT purchase_no, NULL, plan_id, store, supplier, series, model, '未发', NULL, certificate, bill_store FROM planned),
    inventory AS (SELECT b.* EXCLUDE (store), CASE WHEN b.store = '直播基地' AND d.network IS NOT NULL THEN concat(d.network, '-', b.store) ELSE b.store END AS store, d.network,
               CASE WHEN supplier = 'SISTER' THEN '内部调入' WHEN supplier <> 'MAKER' THEN '外部调入' END AS source_kind
             FROM both_kinds b LEFT JOIN {{series_dim}} d ON d.series = b.series)"""


@query(
    "m6_inventory",
    f"""WITH {INVENTORY} SELECT purchase_no, vin, plan_id, store, network, supplier, source_kind, vehicle_status, certificate, bill_store,
           strftime(invoice_date, '%Y-%m-%d') AS invoice_date FROM inventory""",
)
def _(t: Tables):
    out = stock.inventory(t.stock, t.plan, bills_of(t), t.series_dim, ["SISTER"], "MAKER")
    return day_texts(out, "invoice_date").select(
        "purchase_no", "vin", "plan_id", "store", "network", "supplier", "source_kind", "vehicle_status", "certificate", "bill_store", "invoice_date"
    )


@query("m6_published_inventory", f"WITH {INVENTORY} SELECT purchase_no, vin, plan_id, store FROM inventory WHERE invoice_date IS NULL")
def _(t: Tables):
    out = stock.inventory(t.stock, t.plan, bills_of(t), t.series_dim, ["SISTER"], "MAKER")
    return stock.published(out).select("purchase_no", "vin", "plan_id", "store")


ORDERS = """
    hosts AS (SELECT DISTINCT id, CASE WHEN phone1 IN ('', '0') OR phone1 IS NULL THEN '' ELSE replace(phone1, '.0', '') END AS phone1,
                CASE WHEN phone2 IN ('', '0') OR phone2 IS NULL THEN '' ELSE replace(phone2, '.0', '') END AS phone2, host, series, buyer, order_store
              FROM (SELECT * FROM {deals} UNION ALL SELECT * FROM {unsold})),
    one_host AS (SELECT phone1, phone2, series, buyer, order_store, min(host) AS host FROM hosts GROUP BY ALL),
    named AS (SELECT o.* EXCLUDE (store), d.network, CASE WHEN o.store = '直播基地' AND d.network IS NOT NULL THEN concat(d.network, '-', o.store) ELSE o.store END AS store
              FROM {order_business} o LEFT JOIN {series_dim} d ON d.series = o.series WHERE NOT voided),
    booked AS (SELECT DISTINCT n.* EXCLUDE (deposit), h.host, CASE WHEN sale_date IS NOT NULL AND (deposit_date IS NULL OR deposit_state = '待收款') THEN '现定现交' END AS cash_and_carry,
                CASE WHEN sale_date IS NOT NULL AND (deposit_date IS NULL OR deposit_state = '待收款') THEN 3000 ELSE deposit END AS deposit
              FROM named n LEFT JOIN one_host h ON h.phone1 = n.phone1 AND h.phone2 = coalesce(n.phone2, '') AND h.series = n.series AND h.buyer = n.buyer AND h.order_store = n.store)"""


def orders_of(t: Tables) -> DataFrame:
    return orders.orders(t.order_business, t.deals, t.unsold, t.series_dim)


@query("m7_orders", f"WITH {ORDERS} SELECT vin, store, network, host, cash_and_carry, deposit, strftime(sale_date, '%Y-%m-%d') AS status_date FROM booked")
def _(t: Tables):
    return day_texts(orders_of(t), "status_date").select("vin", "store", "network", "host", "cash_and_carry", "deposit", "status_date")


VOIDED = """
    voided AS (SELECT v.* EXCLUDE (store), CASE WHEN v.store = '直播基地' AND d.network IS NOT NULL THEN concat(d.network, '-', v.store) ELSE v.store END AS store,
               CASE WHEN date_trunc('month', order_date) = date_trunc('month', void_date) THEN 0 ELSE 1 END AS not_counted
             FROM {void_business} v LEFT JOIN {series_dim} d ON d.series = v.series WHERE void_type IS NULL OR void_type NOT IN ('重复录入', '错误录入'))"""


@query("m8_void_orders", f"WITH {VOIDED} SELECT buyer, store, void_type, strftime(void_date, '%Y-%m-%d') AS cancel_date, not_counted FROM voided")
def _(t: Tables):
    out = orders.void_orders(t.void_business, t.series_dim)
    return day_texts(out, "cancel_date").select("buyer", "store", "void_type", "cancel_date", "not_counted")


@query("m9_sales_detail", f"WITH {PROFIT} SELECT vin, store, network, series, team, invoice_price, strftime(sale_date, '%Y-%m-%d') AS sale_date FROM detail")
def _(t: Tables):
    out = sales.sales_detail(t.sales, t.series_dim, "1996-12-31")
    return day_texts(out, "sale_date").select("vin", "store", "network", "series", "team", "invoice_price", "sale_date")


M10 = ["vat_margin", "tax", "cash_back", "promo_cost", "used_rebate", "finance_fee", "finance_profit", "plate_profit", "gift_total", "sale_price", "gross", "unit_profit"]


@query(
    "m10_sales_profit",
    f"WITH {PROFIT} SELECT vin, store, team, mode, finance_type, transfer_kind, gift_items, package_items, invoice_store, {', '.join(f'round({c}, 2) + 0 AS {c}' for c in M10)} FROM profit",
)
def _(t: Tables):
    out = cents(profit_of(t), *M10)
    return out.select("vin", "store", "team", "mode", "finance_type", "transfer_kind", "gift_items", "package_items", "invoice_store", *M10)


@query(
    "m10_profit_by_store",
    f"WITH {PROFIT} SELECT store, count(*) AS sold, round(sum(round(unit_profit, 2)::decimal(18, 2)), 2)::double AS unit_profit FROM profit GROUP BY store",
)
def _(t: Tables):
    from motorledger.operators.groups import group_agg

    money = F.sum(F.round("unit_profit", 2).cast("decimal(18,2)")).cast("double")
    return group_agg(profit_of(t), ["store"], {"sold": F.count(F.lit(1)), "unit_profit": money})


MOVED = """
    moved AS (SELECT m.vin, m.out_store AS store, m.pay_store AS buyer, CASE WHEN instr(m.vehicle_info, ' ') > 0 THEN substr(m.vehicle_info, instr(m.vehicle_info, ' ') + 1) ELSE m.vehicle_info END AS vehicle_info,
                s.sale_date, s.series AS series_1, s.model, s.fee AS transfer_fee
              FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY settle_date DESC, out_store, pay_store, vehicle_info) AS rn FROM {transfer_business}) m
              JOIN profit s ON s.vin = m.vin WHERE rn = 1 AND s.fee <> 0)"""


@query("m11_transfers", f"WITH {PROFIT}, {MOVED} SELECT vin, store, buyer, vehicle_info, series_1, model, transfer_fee, '调拨车' AS series, '其他' AS team, '是' AS transferred_out FROM moved")
def _(t: Tables):
    out = sales.transfers(t.transfer_business, profit_of(t))
    return out.select("vin", "store", "buyer", "vehicle_info", "series_1", "model", "transfer_fee", "series", "team", "transferred_out")


FINAL = f"""{PROFIT}, {MOVED}, {ORDERS},
    ids AS (SELECT vin, id_number FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY order_date DESC, id_number) AS rn FROM booked) WHERE rn = 1),
    homes AS (SELECT vin, source_store, supplier, engine_no FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY source_store, supplier NULLS LAST, engine_no) AS rn FROM {{stock}}) WHERE rn = 1),
    final AS (SELECT p.vin, p.store, p.series, p.team, p.buyer, i.id_number, h.source_store, h.supplier, p.used_rebate, CASE WHEN p.used_rebate > 0 THEN coalesce(p.receipt_date, p.sale_date) ELSE p.receipt_date END AS receipt_date,
                p.sale_date, round(p.unit_profit, 2) + 0 AS unit_profit FROM profit p LEFT JOIN ids i ON i.vin = p.vin LEFT JOIN homes h ON h.vin = p.vin
              UNION SELECT DISTINCT '二手车返利', store, '二手车返利', '二手车返利', buyer, NULL, NULL, NULL, used_rebate, receipt_date, receipt_date, used_rebate
              FROM (SELECT DISTINCT * FROM loose)
              UNION SELECT vin, store, '调拨车', '其他', buyer, NULL, NULL, NULL, 0, NULL, sale_date, transfer_fee FROM moved)"""


M11 = ["vin", "store", "series", "team", "buyer", "id_number", "source_store", "supplier", "used_rebate", "receipt_date", "sale_date", "unit_profit"]


def final_of(t: Tables, columns: list[str] | None = None) -> DataFrame:
    """The whole table is written in two parts; of some ``columns`` it is not written."""
    profit, (loose, _) = written(profit_of(t), "profit"), used_parts(t)
    moved = written(sales.transfers(t.transfer_business, profit), "transfers")
    booked = written(orders_of(t).select("vin", "id_number", "order_date"), "booked")
    return sales.sales_final(profit, loose, moved, booked, t.stock, columns, written)


@query(
    "m11_sales_final",
    f"""WITH {FINAL} SELECT DISTINCT vin, store, series, team, buyer, id_number, source_store, supplier, used_rebate,
           strftime(receipt_date, '%Y-%m-%d') AS receipt_date, strftime(sale_date, '%Y-%m-%d') AS sale_date, unit_profit FROM final""",
)
def _(t: Tables):
    out = day_texts(cents(final_of(t, M11), "unit_profit"), "receipt_date", "sale_date")
    return out.select(*M11).distinct()


@query(
    "m12_document_export",
    f"""WITH {FINAL}, shown AS (SELECT vin, CASE WHEN contains(store, '直播基地') THEN '直播基地' ELSE store END AS store, coalesce(team, '') AS team, series, sale_date FROM final)
        SELECT 'sales' AS kind, vin, store, team, strftime(sale_date, '%Y/%m/%d') AS sale_date FROM (SELECT *, row_number() OVER (PARTITION BY vin, series ORDER BY sale_date DESC) AS rn
          FROM shown WHERE vin <> '二手车返利') WHERE rn = 1
        UNION SELECT 'sales', vin, store, team, strftime(sale_date, '%Y/%m/%d') FROM shown WHERE vin = '二手车返利'
        UNION SELECT 'transfers', vin, store, team, strftime(sale_date, '%Y/%m/%d') FROM shown WHERE sale_date >= '1998-01-01' AND team IN ('调拨', '其他')""",
)
def _(t: Tables):
    paid = accessories.paid(decoration_lines(t))
    cols = ["vin", "store", "team", "sale_date"]
    sold, _, moved = sales.export_tables(final_of(t), paid, ["team", "store"], ["unit_profit"], CUT, cols)
    parts = [df.select(F.lit(kind).alias("kind"), *cols) for kind, df in (("sales", sold), ("transfers", moved))]
    return parts[0].unionByName(parts[1]).distinct()


@query(
    "m12_accessories_document",
    QUERIES["m1_paid_accessories"].sql.replace("WHERE NOT gift AND (seller IS NULL OR seller NOT IN ('S7'))", "WHERE NOT gift").replace(
        "SELECT * REPLACE (round(revenue, 2) AS revenue), round(revenue - cost, 2) AS profit FROM grouped",
        "SELECT vin, seller, CASE WHEN contains(store, '直播基地') THEN '直播基地' ELSE store END AS store, first_receipt, items FROM grouped WHERE first_receipt >= '1998/01/01'",
    ),
)
def _(t: Tables):
    paid = accessories.paid(decoration_lines(t))
    final = t.sales.withColumn("unit_profit", F.lit(0.0))
    _, sold, _ = sales.export_tables(final, paid, ["team", "store"], ["unit_profit"], CUT)
    return sold.select("vin", "seller", "store", "first_receipt", "items")


# -- dashboards: the same table plays archive and current, cut at one day ----------------


@query(
    "m13_dashboard_sales",
    """WITH now AS (SELECT *, '36,24' AS term, NULL AS vehicle_info, NULL AS finance_type FROM {sales}),
            old AS (SELECT vin, store, series, model, trim, team, strptime(strftime(sale_date, '%Y-%m-01'), '%Y-%m-%d') AS sale_date FROM {sales} WHERE sale_date < '1998-01-01'),
            u AS (SELECT vin, store, series, model, trim, team, sale_date, '36期' AS term_label, 5.0 AS used_rebate FROM now
                  UNION ALL SELECT vin, store, series, model, trim, team, sale_date, NULL, NULL FROM old)
       SELECT vin, u.store, d.network, CASE WHEN team IN ('调拨', '其他') THEN '其他' ELSE team END AS team,
              CASE WHEN team IN ('调拨', '其他') THEN '调出车' END AS finance_type, CASE WHEN team IN ('调拨', '其他') THEN '是' ELSE '' END AS transferred_out,
              CASE WHEN team = '调拨' THEN series || ' ' || trim END AS vehicle_info, coalesce(trim, model) AS trim, term_label,
              strftime(sale_date, '%Y-%m-%d') AS sale_date, CASE WHEN used_rebate <> 0 THEN strftime(sale_date, '%Y-%m-%d') END AS receipt_date
       FROM u LEFT JOIN {store_dim} d ON d.store = u.store""",
)
def _(t: Tables):
    none = F.lit(None).cast("string")
    now = t.sales.withColumns(
        {"term": F.lit("36,24"), "vehicle_info": none, "finance_type": none, "used_rebate": F.lit(5.0), "receipt_date": F.lit(None).cast("timestamp_ntz")}
    )
    label = F.concat(F.year("sale_date").cast("string"), F.lit("年"), F.month("sale_date").cast("string"), F.lit("月"))
    old = t.sales.select("vin", "store", "series", "model", "trim", "team", label.alias("sale_date"))
    out = day_texts(dashboard.sales(now, old, t.store_dim, CUT), "sale_date", "receipt_date")
    return out.select("vin", "store", "network", "team", "finance_type", "transferred_out", "vehicle_info", "trim", "term_label", "sale_date", "receipt_date")


@query(
    "m13_dashboard_delivered",
    """WITH a AS (SELECT vin, max(arrival_date) AS arrived FROM {stock} WHERE vin IS NOT NULL GROUP BY vin),
            u AS (SELECT vin, team, coalesce(trim, model) AS trim, NULL AS arrival_date, sale_date,
                    CASE WHEN date_trunc('month', order_date) = date_trunc('month', sale_date) THEN 1 ELSE 0 END AS sold_in_month
                  FROM {sales} WHERE team IS NULL OR team NOT IN ('调拨', '其他', '二手车返利')
                  UNION ALL SELECT vin, team, coalesce(trim, model), stock_in_date, sale_date, NULL FROM {sales} WHERE sale_date < '1998-01-01')
       SELECT u.vin, team, trim, sold_in_month, strftime(coalesce(arrival_date, arrived), '%Y-%m-%d') AS arrival_date, strftime(sale_date, '%Y-%m-%d') AS sale_date
       FROM u LEFT JOIN a ON a.vin = u.vin""",
)
def _(t: Tables):
    now = t.sales.withColumn("arrival_date", F.lit(None).cast("timestamp_ntz"))
    old = t.sales.withColumnRenamed("stock_in_date", "arrival_date")
    out = day_texts(dashboard.delivered(now, old, t.stock, CUT), "arrival_date", "sale_date")
    return out.select("vin", "team", "trim", "sold_in_month", "arrival_date", "sale_date")


def both_orders(t: Tables):
    booked = dashboard.booked(t.order_business, t.order_business.drop("approval"), CUT)
    void = orders.void_orders(t.void_business, t.series_dim)
    return booked, dashboard.cancelled(void, void, CUT)


BOOKED = """
    now_booked AS (SELECT * FROM {order_business} WHERE order_date >= '1998-01-01' AND approval = '审核通过'),
    dash_booked AS (SELECT vin, store, coalesce(trim, model) AS trim, order_date, approval FROM now_booked
      UNION ALL SELECT vin, store, coalesce(trim, model), order_date, NULL FROM {order_business} WHERE order_date < '1998-01-01')"""


@query("m13_dashboard_orders", f"WITH {BOOKED} SELECT vin, store, trim, approval, strftime(order_date, '%Y-%m-%d') AS order_date FROM dash_booked")
def _(t: Tables):
    return day_texts(both_orders(t)[0], "order_date").select("vin", "store", "trim", "approval", "order_date")


@query(
    "m13_all_orders",
    f"""WITH {BOOKED}, {VOIDED}, c AS (SELECT * FROM voided UNION ALL SELECT * FROM voided WHERE void_date < '1998-01-01')
        SELECT vin, NULL AS buyer, -1 AS not_counted, strftime(order_date, '%Y-%m-%d') AS effective_date FROM dash_booked
        UNION ALL SELECT NULL, buyer, not_counted, strftime(coalesce(void_date, order_date), '%Y-%m-%d') FROM c""",
)
def _(t: Tables):
    booked, void = both_orders(t)
    out = day_texts(dashboard.all_orders(booked.drop("buyer"), void), "effective_date")
    return out.select("vin", "buyer", "not_counted", "effective_date")


@query(
    "m13_dashboard_stock",
    """WITH p AS (SELECT id, min({'i': i, 'd': d}).d AS plan_date FROM (
            SELECT concat('P', cast(o_orderkey * 10 AS string)) AS id, 0 AS i, o_orderdate AS d FROM orders
            UNION ALL SELECT concat('P', cast(o_orderkey * 10 + 3 AS string)), 1, o_orderdate FROM orders
            UNION ALL SELECT CASE WHEN o_orderstatus = 'F' THEN concat('P', cast(o_orderkey * 10 + 4 AS string)) END, 2, o_orderdate FROM orders) WHERE id IS NOT NULL GROUP BY id)
       SELECT s.purchase_no, vin, CASE WHEN vehicle_status IN ('未发', '在途') THEN '未到库' WHEN stock_days >= 180 THEN '180天以上' WHEN stock_days >= 120 THEN '120-180天'
              WHEN stock_days >= 90 THEN '90-120天' WHEN stock_days >= 60 THEN '60-90天' WHEN stock_days >= 30 THEN '30-60天' ELSE '30天以下' END AS age_class,
              date_diff('day', coalesce(plan_date, shipped_date), arrival_date)::int + 1 AS lead_days
       FROM {stock} s LEFT JOIN p ON p.id = s.purchase_no""",
)
def _(t: Tables):
    number = lambda k: F.concat(F.lit("P"), (F.col("o_orderkey") * 10 + k).cast("string"))
    plans = t.orders.select(
        number(0).alias("purchase_no"), number(3).alias("service_no"),
        F.when(F.col("o_orderstatus") == "F", number(4)).alias("change_no"), F.col("o_orderdate").alias("plan_date"),
    )
    return dashboard.stock(t.stock, plans).select("purchase_no", "vin", "age_class", "lead_days")


@query(
    "m13_dashboard_accessories",
    """WITH u AS (SELECT vin, store, NULL AS district, CASE WHEN seller = 'S1' THEN 'AUTOMOBILE' ELSE 'FURNITURE' END AS series, receipt_date FROM {decoration} WHERE receipt_date >= '1998-01-01'
                  UNION ALL SELECT vin, d.store, s.district, 'AUTOMOBILE', receipt_date FROM {decoration} d LEFT JOIN {store_dim} s ON s.store = d.store
                  WHERE receipt_date < '1998-01-01' OR s.district = 'D2')
       SELECT vin, u.store, district, d.network, strftime(receipt_date, '%Y-%m-%d') AS sold_date FROM u LEFT JOIN {series_dim} d ON d.series = u.series""",
)
def _(t: Tables):
    series = F.when(F.col("seller") == "S1", F.lit("AUTOMOBILE")).otherwise(F.lit("FURNITURE"))
    now = t.decoration.select("vin", "store", series.alias("series"), F.date_format("receipt_date", "yyyy/MM/dd").alias("first_receipt"))
    old = t.decoration.select("vin", "store", F.lit("AUTOMOBILE").alias("series"), F.date_format("receipt_date", "yyyy/MM/dd").alias("sold_date"))
    out = dashboard.accessories(now, old, t.store_dim, t.series_dim, "D2", CUT)
    return day_texts(out, "sold_date").select("vin", "store", "district", "network", "sold_date")


@query(
    "m13_dashboard_bills",
    f"""WITH {BILLS}, u AS (SELECT bill_no, bank, redeemed, due_date AS newest_due FROM bills WHERE redeemed = 0 OR issue_date >= '1998-01-01'
                UNION ALL SELECT bill_no, bank, redeemed, NULL FROM bills WHERE redeemed = 1)
        SELECT bill_no, redeemed, strftime(newest_due, '%Y-%m-%d') AS newest_due, CASE WHEN contains(bank, '光大') THEN '光大' WHEN contains(bank, '招商') THEN '招商'
               WHEN contains(bank, '工商') THEN '工商' ELSE bank END AS bank FROM u""",
)
def _(t: Tables):
    bills = bills_of(t)
    return day_texts(dashboard.bills(bills, bills, CUT), "newest_due").select("bill_no", "redeemed", "newest_due", "bank")


@query(
    "m13_dashboard_used_cars",
    "SELECT buyer AS old_owner, model AS old_brand, deal_price AS price FROM {used_cars} UNION ALL SELECT c_name, NULL, c_acctbal FROM customer",
)
def _(t: Tables):
    archive = t.customer.select(F.col("c_name").alias("old_owner"), F.col("c_acctbal").alias("price"))
    return dashboard.used_cars(t.used_cars, archive, {"buyer": "old_owner", "model": "old_brand", "deal_price": "price"})


@query(
    "m14_finished_sales",
    """SELECT vin, CASE WHEN s.series = 'MACHINERY' AND trade_in = 1000 THEN 'MACHINERY 2' ELSE s.series END AS series, d.kind
       FROM {sales} s LEFT JOIN {series_dim} d ON d.series = CASE WHEN s.series = 'MACHINERY' AND trade_in = 1000 THEN 'MACHINERY 2' ELSE s.series END
       WHERE sale_date < '2001-07-01'""",
)
def _(t: Tables):
    sold = t.sales.withColumn("receipt_date", F.col("sale_date")).withColumn("settle_price", F.col("trade_in"))
    split = dashboard.renamed_series(sold, "MACHINERY", 1000.0, "MACHINERY 2")
    return dashboard.finished_sales(split, t.series_dim, datetime(2001, 7, 1, 10)).select("vin", "series", "kind")


@query(
    "m14_seller_tenure",
    """SELECT seller, store, tenure_days, ceil(tenure_days / 30.0)::int AS tenure_months, concat(store, '-', seller) AS seller_key FROM (
         SELECT seller, max({'t': sale_date, 's': store}).s AS store, date_diff('day', min(sale_date), max(sale_date))::int AS tenure_days FROM {sales} GROUP BY seller)""",
)
def _(t: Tables):
    return dashboard.seller_tenure(t.sales)


@query("m14_key_accounts", "SELECT purchase_no, vin, CASE WHEN purchase_no IN (SELECT purchase_no FROM {plan}) THEN '大客户' ELSE '非大客户' END AS key_account FROM {stock}")
def _(t: Tables):
    return dashboard.with_key_account(t.stock, t.plan).select("purchase_no", "vin", "key_account")


@query(
    "m14_catalogue",
    """WITH u AS (SELECT 0 AS src, series, model, trim, colour FROM {sales} UNION ALL SELECT 1, series, model, trim, colour FROM {stock}
                  UNION ALL SELECT 2, p_brand, NULL, concat(' ', p_name, '  ', p_type), 'C1' FROM part),
            k AS (SELECT src, series, coalesce(model, trim) AS model, trim, colour, replace(regexp_replace(lower(trim(concat(coalesce(series, ''), coalesce(trim, '')))), '\\s+', ' ', 'g'), 'e2', 'E2') AS label FROM u)
       SELECT series, trim(model) AS model, trim, colour FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY src, series, model, trim NULLS LAST, colour) AS rn FROM k) WHERE rn = 1""",
)
def _(t: Tables):
    parts = t.part.select(
        F.col("p_brand").alias("series"), F.lit(None).cast("string").alias("model"),
        F.concat(F.lit(" "), "p_name", F.lit("  "), "p_type").alias("trim"), F.lit("C1").alias("colour"),
    )
    return dashboard.catalogue([t.sales, t.stock, parts])


MARKETING = """SELECT concat(cast(year(o_orderdate) AS string), '年', cast(month(o_orderdate) AS string), '月') AS year_month, concat('NATION_', cast(o_custkey % 25 AS string)) AS store,
    'C' AS category, CASE WHEN o_orderkey % 4 = 0 THEN '随车' WHEN o_orderkey % 4 = 1 THEN NULL ELSE 'ad' END AS subcategory,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE cast(o_orderkey AS string) END AS total_amount, cast(o_custkey AS string) AS amount FROM {orders}"""


@query(
    "m15_marketing_by_store",
    f"""WITH r AS ({MARKETING}) SELECT strftime(strptime(replace(replace(year_month, '年', '-'), '月', '-1'), '%Y-%m-%d'), '%Y-%m-%d') AS month,
           CASE WHEN store = 'NATION_3' THEN 'NATION_4' ELSE store END AS store, sum(cast(coalesce(total_amount, amount) AS double)) AS amount
        FROM r WHERE subcategory IS DISTINCT FROM '随车' GROUP BY 1, 2""",
)
def _(t: Tables):
    return day_texts(costs.marketing_by_store(costs.marketing(t.sql(MARKETING), ALIAS)), "month")


@query(
    "m15_category_by_rule_date",
    f"""WITH r AS ({MARKETING}) SELECT CASE WHEN strptime(replace(replace(year_month, '年', '-'), '月', '-1'), '%Y-%m-%d') < '{{day}}' THEN category ELSE subcategory END AS item,
           sum(cast(coalesce(total_amount, amount) AS double)) AS amount, count(*) AS lines FROM r GROUP BY 1""".replace("{day}", "1999-06-15"),
)
def _(t: Tables):
    found = costs.marketing(t.sql(MARKETING), ALIAS, RULE_DAY)
    return found.groupBy("item").agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("lines"))


@query(
    "m15_salary_by_store",
    """SELECT strftime(last_day(DATE '1899-12-30' + cast(44927 + o_orderkey % 365 AS int)), '%Y-%m-%d') AS month, concat('NATION_', cast(o_custkey % 25 AS string)) AS store,
              sum(o_custkey::double + CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey END) AS total_pay FROM orders GROUP BY 1, 2""",
)
def _(t: Tables):
    df = t.orders.select(
        (44927 + F.col("o_orderkey") % 365).cast("string").alias("year_month"), F.concat(F.lit("NATION_"), F.col("o_custkey") % 25).alias("store"),
        F.col("o_custkey").cast("string").alias("pay"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey").cast("string")).alias("social_security"),
    )
    return day_texts(costs.salary_by_store(df), "month")


@query(
    "m16_special_income",
    """SELECT c_name AS buyer, CASE WHEN c_nationkey = 3 THEN 'NATION_4' ELSE concat('NATION_', c_nationkey) END AS store, c_acctbal AS amount FROM customer WHERE c_acctbal > 0
       UNION ALL SELECT c_name, NULL, 0 FROM customer WHERE c_acctbal <= 0""",
)
def _(t: Tables):
    folder = shared_folder(t.spark, "income")
    store = F.concat(F.lit("NATION_"), "c_nationkey").alias("store")
    out = lambda df, name: df.write.option("header", True).csv(f"{folder}/{name}")
    out(t.customer.where("c_acctbal > 0").select(store, F.col("c_name").alias("buyer"), F.col("c_acctbal").alias("amount"), F.lit("x").alias("more")), "a")
    out(t.customer.where("c_acctbal <= 0").select(F.col("c_name").alias("Buyer "), F.lit("none").alias("amount")), "b")
    ledger = read_ledger_dir(t.spark, folder, costs.INCOME_COLUMNS)
    return costs.special_income(ledger, ALIAS).select("buyer", "store", "amount")


@query(
    "m17_long_scores",
    """SELECT CASE WHEN c_nationkey = 3 THEN 'NATION_4' ELSE concat('NATION_', c_nationkey) END AS store, 'all' AS region, concat('2026年', m, '月得分') AS attribute,
              cast(count(*) FILTER (month(o_orderdate) = m) AS varchar) AS value
       FROM orders JOIN customer ON c_custkey = o_custkey JOIN (SELECT unnest([1, 2, 3]) AS m) ON true GROUP BY c_nationkey, m""",
)
def _(t: Tables):
    wide = monthly_wide(t).withColumns({"store": F.concat(F.lit("NATION_"), "store"), "region": F.lit("all")})
    return costs.long_table(wide, ["store", "region"], ALIAS, "filter_score")


FITTED = """
    fit AS (SELECT * FROM {decoration} WHERE (item_state IS NULL OR item_state NOT IN ('已换货', '已退货', '已退款')) AND receipt_date IS NOT NULL),
    visit AS (SELECT vin, min(receipt_date) AS visit_date, min_by(store, (receipt_date, store)) AS visit_store, string_agg(item, '，' ORDER BY item) AS items,
                round(sum(CASE WHEN contains(item, '膜') THEN revenue ELSE 0 END), 2) AS film_revenue, round(sum(CASE WHEN contains(item, '膜') THEN 0 ELSE revenue END), 2) AS other_revenue,
                sum(CASE WHEN contains(item, '龙膜') THEN cost ELSE 0 END) AS brand_cost FROM fit WHERE vin IS NOT NULL GROUP BY vin),
    push AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY right(vin, 6) ORDER BY push_day DESC, money) AS rn FROM (
               SELECT vin, cast(replace(push_date, '/', '-') AS timestamp)::date AS push_day, coalesce(cast(nullif(commission, '') AS double), 0)
                      - CASE WHEN trim(gift) <> '' THEN 200 ELSE 0 END AS money FROM {film_push} WHERE push_date <> 'bad')) WHERE rn = 1),
    shop AS (SELECT store, year(receipt_date) AS year, month(receipt_date) AS month, sum(cost) AS shop_cost FROM {decoration} WHERE receipt_date IS NOT NULL GROUP BY 1, 2, 3)"""


@query(
    "m18_film_funnel",
    f"""WITH {FITTED}, {GIFT_LINES},
        base AS (SELECT s.vin, s.store, push_day, money AS commission, v.*EXCLUDE (vin), c.shop_cost, g.gift_items,
                   row_number() OVER (PARTITION BY s.store, year(visit_date), month(visit_date) ORDER BY s.vin) AS rn
                 FROM {{sales}} s LEFT JOIN push p ON right(p.vin, 6) = right(s.vin, 6) LEFT JOIN visit v ON v.vin = s.vin LEFT JOIN gifts g ON g.vin = s.vin
                   LEFT JOIN shop c ON c.store = s.store AND c.year = year(visit_date) AND c.month = month(visit_date))
        SELECT vin, store, strftime(push_day, '%Y-%m-%d') AS push_date, commission, strftime(visit_date, '%Y-%m-%d') AS visit_date, visit_store, items, film_revenue, other_revenue, brand_cost,
               CASE WHEN rn = 1 THEN shop_cost ELSE 0 END AS shop_cost, CASE WHEN contains(gift_items, '膜') THEN '是' ELSE '否' END AS gift_film,
               CASE WHEN push_day IS NULL THEN '否' ELSE '是' END AS pushed, CASE WHEN visit_date IS NULL THEN '否' ELSE '是' END AS visited,
               CASE WHEN visit_date IS NULL THEN '未到店' WHEN film_revenue IS NULL OR film_revenue = 0 THEN '是' ELSE '否' END AS free_film,
               CASE WHEN other_revenue > 0 THEN '是' ELSE '否' END AS other_upgrade,
               CASE WHEN other_revenue > 0 AND (film_revenue IS NULL OR film_revenue = 0) THEN '是' ELSE '否' END AS other_only,
               CASE WHEN floor(epoch(visit_date - push_day) / 86400) BETWEEN 0 AND 90 THEN '是' ELSE '否' END AS within_90_days,
               CASE WHEN contains(gift_items, '龙膜') THEN '是' ELSE '否' END AS brand_film_gift FROM base""",
)
def _(t: Tables):
    from motorledger.operators.joins import left_lookup

    gifts = accessories.gifts(decoration_lines(t)).select("vin", "gift_items")
    sold = left_lookup(t.sales.select("vin", "store", "sale_date"), gifts, ["vin"])
    shop = t.decoration.where(F.col("receipt_date").isNotNull()).groupBy(
        "store", F.year("receipt_date").alias("year"), F.month("receipt_date").alias("month")
    ).agg(F.sum("cost").alias("shop_cost"))
    out = film.funnel(sold, film.pushes(t.film_push, {}), film.visits(t.decoration), shop)
    out = day_texts(cents(out, "film_revenue", "other_revenue"), "push_date", "visit_date")
    return out.select(
        "vin", "store", "push_date", "commission", "visit_date", "visit_store", "items", "film_revenue", "other_revenue", "brand_cost", "shop_cost",
        "gift_film", "pushed", "visited", "free_film", "other_upgrade", "other_only", "within_90_days", "brand_film_gift",
    )


@query(
    "m19_film_ledger",
    """SELECT vin, CASE WHEN store = 'NATION_3' THEN 'NATION_4' ELSE store END AS store, coalesce(arrived, push_date) AS arrival_date, arrived AS arrival_as_given,
              m - CASE WHEN m > 0 AND trim(gift) <> '' THEN 200 ELSE 0 END AS store_commission
       FROM (SELECT *, CASE WHEN commission IS NULL THEN push_date END AS arrived, coalesce(cast(nullif(commission, '') AS double), 0) AS m FROM {film_push})""",
)
def _(t: Tables):
    lines = t.film_push.withColumn("arrival_date", F.when(F.col("commission").isNull(), F.col("push_date")))
    return film.ledger(lines, ALIAS).select("vin", "store", "arrival_date", "arrival_as_given", "store_commission")


def protection_docs(t: Tables) -> DataFrame:
    """The documents land as JSON and are scanned from there."""
    folder = shared_folder(t.spark, "protection")
    docs = t.protection_docs
    docs.write.json(folder)
    return read_documents(t.spark, folder, docs.schema)


PROTECTED = """
    docs AS (SELECT *, CASE WHEN invoice_date > product_sale_date THEN invoice_date ELSE product_sale_date END AS day FROM {protection_docs}
             WHERE validity = '有效' AND department = '售前' AND (product_sale_date < '2026-03-01' OR vin IN (SELECT vin FROM {terminal_vins}))),
    book AS (SELECT vin, series, store, product_sale_date AS sale_date, CASE WHEN invoice_date <= product_sale_date THEN product_sale_date ELSE invoice_date END AS invoice_date FROM {protection_docs} WHERE department = '售后'),
    prot AS (SELECT vin, series, store, product_sale_date AS sale_date, invoice_date, day, product_amount - cost AS profit FROM docs
             UNION ALL SELECT vin, series, store, sale_date, invoice_date, coalesce(invoice_date, sale_date), NULL FROM book)"""


def protection_of(t: Tables, rule_date: str = V.TERMINAL_RULE_DATE) -> DataFrame:
    sold = products.protection_sales(protection_docs(t), t.terminal_vins, {}, rule_date=rule_date)
    book = t.protection_docs.where("department = '售后'").withColumnRenamed("product_sale_date", "sale_date")
    ledger = products.protection_ledger(book, ["vin", "series", "sale_date", "invoice_date", "buyer", "store"], {})
    return products.protection(sold, ledger, t.series_dim, ALIAS, rule_date)


#: A rule date inside the given data, so that both sides of it have rows.
RULE_DAY = "1999-06-15"
RULED = PROTECTED.replace("2026-03-01", RULE_DAY)


@query(
    "m20_protection_by_rule_date",
    f"""WITH {RULED} SELECT DISTINCT vin, strftime(sale_date, '%Y-%m-%d') AS sale_day, profit,
           CASE WHEN sale_date > '{RULE_DAY}' THEN '是' ELSE '否' END AS after_rule_date FROM prot""",
)
def _(t: Tables):
    out = protection_of(t, RULE_DAY).withColumn("sale_day", F.date_format("sale_date", DAY))
    return out.select("vin", "sale_day", "profit", "after_rule_date").distinct()


@query(
    "m20_protection",
    f"""WITH {PROTECTED} SELECT DISTINCT vin, CASE WHEN p.store = '直播基地' AND d.network IS NOT NULL THEN concat(d.network, '-', p.store) WHEN p.store = 'NATION_3' THEN 'NATION_4' ELSE p.store END AS store,
           CASE WHEN contains(p.store, '贵州') THEN '贵州' ELSE '成都' END AS city, profit, strftime(day, '%Y-%m-%d') AS day,
           CASE WHEN invoice_date IS NULL THEN '缺少日期' WHEN sale_date < invoice_date + INTERVAL 3 MONTH THEN '是' ELSE '否' END AS within_3_months,
           CASE WHEN sale_date > '2026-03-01' THEN '是' ELSE '否' END AS after_rule_date FROM prot p LEFT JOIN {{series_dim}} d ON d.series = p.series""",
)
def _(t: Tables):
    out = protection_of(t).withColumn("day", F.date_format("date", DAY))
    return out.select("vin", "store", "city", "profit", "day", "within_3_months", "after_rule_date").distinct()


@query(
    "m21_protection_cost",
    """WITH d AS (SELECT *, CASE WHEN contains(store, '贵州') THEN '贵州' ELSE '成都' END AS region, regexp_replace(version, '畅行.*', '畅行版') AS spec,
              CASE WHEN invoice_price < 100000 THEN '0-10万' WHEN invoice_price < 150000 THEN '10-15万' WHEN invoice_price < 200000 THEN '15-20万' WHEN invoice_price < 250000 THEN '20-25万'
                   WHEN invoice_price < 300000 THEN '25-30万' WHEN invoice_price < 350000 THEN '30-35万' ELSE '35-40万' END AS price_band
              FROM {protection_docs} WHERE validity = '有效' AND department = '售前' AND state = '生效'),
            p AS (SELECT * REPLACE (strptime(replace(valid_from, '/', '-'), '%Y-%m-%d') AS valid_from, cast(valid_to AS timestamp) AS valid_to) FROM {protection_prices}),
            m AS (SELECT d.*, p.cost AS rule_cost, row_number() OVER (PARTITION BY vin ORDER BY valid_from DESC, valid_to DESC, p.cost DESC) AS rn FROM d JOIN p
              ON p.region = d.region AND p.network = d.network AND p.stage = d.stage AND p.price_band = d.price_band AND p.spec = d.spec AND p.vehicle_kind = d.vehicle_kind
              AND d.product_sale_date BETWEEN valid_from AND valid_to)
       SELECT vin, price_band, rule_cost, product_amount - rule_cost AS profit FROM m WHERE rn = 1""",
)
def _(t: Tables):
    return products.protection_cost(t.protection_docs, t.protection_prices).select("vin", "price_band", "rule_cost", "profit")


POLICIES = f"""{PROTECTED},
    pol AS (SELECT vin, insurer, store, compulsory_premium, business_source, policy_date FROM (SELECT i.* EXCLUDE (store), CASE WHEN i.store = '直播基地' AND d.network IS NOT NULL
              THEN concat(d.network, '-', i.store) ELSE i.store END AS store FROM {{insurance_business}} i LEFT JOIN {{series_dim}} d ON d.series = i.series WHERE policy_date >= '1998-01-01')
            UNION ALL SELECT vin, insurer, store, compulsory_premium, business_source, policy_date FROM {{insurance_business}} WHERE policy_date < '1998-01-01'),
    flagged AS (SELECT * REPLACE (CASE WHEN store = 'NATION_3' THEN 'NATION_4' ELSE store END AS store), CASE WHEN vin IN (SELECT vin FROM prot) THEN '是' ELSE '否' END AS protected FROM pol WHERE insurer IS NOT NULL),
    bad AS (SELECT DISTINCT vin FROM flagged WHERE (contains(insurer, '鼎和') OR cast(compulsory_premium AS double) IN (1000, 1130, 1800) OR business_source IN ('营运')) AND protected = '否')"""


def policies_of(t: Tables) -> DataFrame:
    raw = t.insurance_business
    archive = raw.where("policy_date < '1998-01-01'").select("vin", "insurer", "store", "compulsory_premium", "business_source", "policy_date")
    current = raw.withColumn("policy_count", F.lit(1))
    return products.insurance(archive, current, t.series_dim, ALIAS, CUT)


@query(
    "m22_insurance_labels",
    f"""WITH {POLICIES} SELECT DISTINCT vin, store, insurer, protected, CASE WHEN vin IN (SELECT vin FROM bad) THEN '不符合' ELSE '符合' END AS rule_label,
           CASE WHEN contains(store, '贵州') THEN '贵州' ELSE '成都' END AS city FROM flagged""",
)
def _(t: Tables):
    out = products.insurance_labels(policies_of(t), protection_of(t), t.deals.select(F.col("host").alias("vin")), t.terminal_vins, ["营运"])
    return out.select("vin", "store", "insurer", "protected", "rule_label", "city").distinct()


@query(
    "m22_labels_by_rule_date",
    f"""WITH {POLICIES.replace("2026-03-01", RULE_DAY)} SELECT DISTINCT vin, strftime(policy_date, '%Y-%m-%d') AS day, insurer, CASE WHEN CASE WHEN policy_date < '{RULE_DAY}' THEN vin IN (SELECT vin FROM bad)
           ELSE vin IN (SELECT host FROM {{deals}}) AND vin NOT IN (SELECT vin FROM {{terminal_vins}}) END THEN '不符合' ELSE '符合' END AS rule_label FROM flagged""",
)
def _(t: Tables):
    approvals = t.deals.select(F.col("host").alias("vin"))
    out = products.insurance_labels(policies_of(t), protection_of(t, RULE_DAY), approvals, t.terminal_vins, ["营运"], rule_date=RULE_DAY)
    return out.select("vin", F.date_format("date", DAY).alias("day"), "insurer", "rule_label").distinct()


@query("m22_insurance_kept", f"WITH {POLICIES} SELECT vin, store, insurer, protected FROM flagged WHERE vin NOT IN (SELECT vin FROM bad)")
def _(t: Tables):
    out = products.insurance_labels(
        policies_of(t), protection_of(t), t.deals.select(F.col("host").alias("vin")), t.terminal_vins, ["营运"], drop_excluded=True
    )
    return out.select("vin", "store", "insurer", "protected")


@query(
    "m23_warranty",
    "SELECT vin, CASE WHEN store = 'NATION_3' THEN 'NATION_4' ELSE store END AS store, cast(nullif(commission, '') AS double) AS amount FROM {film_push} WHERE commission IS NOT NULL",
)
def _(t: Tables):
    ledger = t.film_push.withColumnsRenamed({"commission": "amount"}).withColumn("warranty_date", F.when(F.col("amount").isNotNull(), F.col("push_date")))
    return products.warranty(ledger, ["vin", "store", "amount", "absent"], ALIAS)


@query(
    "m24_accessory_archive",
    """SELECT id, CASE WHEN store = 'NATION_3' THEN 'NATION_4' ELSE store END AS store, qty AS plate, labour_fee AS film, (2 + 1) AS item_count FROM {decoration} WHERE receipt_date IS NOT NULL""",
)
def _(t: Tables):
    ledger = t.decoration.select(
        "id", "store", F.col("receipt_date").alias("sale_date"), F.concat(F.lit("约"), F.col("qty").cast("string"), F.lit("元")).alias("plate"),
        F.concat(F.lit("¥"), F.col("labour_fee").cast("string")).alias("film"),
    )
    out = accessories.accessory_archive(ledger, ["id", "store", "sale_date", "plate", "film", "gone"], ["plate", "film", "gone"], {"plate": 2}, ALIAS)
    return out.select("id", "store", "plate", "film", "item_count")


def quality_sheets(t: Tables):
    """Month and quarter sheets per store out of the order counts."""
    month = F.month("o_orderdate")
    n = lambda m: F.count_if(month == m)
    store = F.concat(F.lit("ST"), (F.col("o_custkey") % 200).cast("string")).alias("store")
    months = t.orders.groupBy(store).agg(
        *[F.when(n(m) > 5, n(m).cast("string")).alias(f"m{m}_score") for m in (1, 2, 3, 4, 5, 6, 10, 11, 12)],
        *[F.when(n(m) % 2 == 0, n(m).cast("string")).alias(f"m{m}_incentive") for m in (2, 3, 4, 5, 6, 10, 11, 12)],
    )
    q = lambda i: F.count_if(F.quarter("o_orderdate") == i)
    quarters = t.orders.groupBy(store).agg(
        *[q(i).cast("string").alias(f"q{i}_score") for i in (1, 2, 3, 4)], *[F.max("o_orderpriority").alias(f"q{i}_result") for i in (1, 2, 3, 4)],
        *[F.when(q(i) % 3 == 0, F.lit("免考核")).when(q(i) % 3 == 1, F.lit("")).otherwise(q(i).cast("string")).alias(f"q{i}_incentive") for i in (1, 2, 3, 4)],
    )
    return months, quarters


@query("m25_rebate_scores", """
    SELECT concat('NATION_', c_nationkey) AS store, concat('2026年', m, '月') AS month, CASE WHEN m <= 3 THEN cast(count(*) FILTER (month(o_orderdate) = m) AS double) END AS score,
           CASE WHEN m >= 2 THEN cast(2 * count(*) FILTER (month(o_orderdate) = m) AS double) END AS factor
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN (SELECT unnest([1, 2, 3, 4]) AS m) ON true GROUP BY c_nationkey, m""")
def _(t: Tables):
    wide = monthly_wide(t).withColumn("store", F.concat(F.lit("NATION_"), "store")).withColumn("line", F.lit(1))
    older = wide.withColumns({"line": F.lit(0), "2026年1月得分": F.lit(-1)})
    return scores.rebate_scores(wide.unionByName(older), "line", {})


@query(
    "m25_service_quality",
    """WITH o AS (SELECT concat('ST', cast(o_custkey % 200 AS string)) AS store, month(o_orderdate) AS m, o_orderpriority FROM orders),
            c AS (SELECT store, m, count(*) AS n FROM o GROUP BY 1, 2), q AS (SELECT store, cast(ceil(m / 3.0) AS int) AS q, sum(n) AS n FROM c GROUP BY 1, 2),
            r AS (SELECT store, max(o_orderpriority) AS result FROM o GROUP BY 1),
            s AS (SELECT r.store, i AS q, coalesce(n, 0) AS n, result, CASE WHEN coalesce(n, 0) % 3 = 0 THEN 0 WHEN n % 3 = 1 THEN NULL ELSE n END::double AS inc
                  FROM r JOIN (SELECT unnest([1, 2, 3, 4]) AS i) ON true LEFT JOIN q ON q.store = r.store AND q.q = i),
            mm AS (SELECT store, cast(ceil(m / 3.0) AS int) AS q, round_even(avg(n) FILTER (n > 5), 2) AS score, sum(n) FILTER (n % 2 = 0 AND m <> 1) AS inc FROM c GROUP BY 1, 2),
            y AS (SELECT s.store, s.q, coalesce(mm.score, 0) AS a, coalesce(mm.inc, 0)::double AS b, s.n::double AS sn, s.inc AS si, s.result FROM s LEFT JOIN mm ON mm.store = s.store AND mm.q = s.q)
       SELECT store, concat('2025Q', q) AS quarter, CASE q WHEN 3 THEN sn WHEN 4 THEN CASE WHEN a <> 0 THEN a ELSE sn END ELSE a END AS score, CASE WHEN q > 2 THEN result END AS result,
              CASE q WHEN 3 THEN si WHEN 4 THEN CASE WHEN b <> 0 THEN b ELSE coalesce(si, b) END ELSE b END AS incentive FROM y
       UNION ALL SELECT store, concat('2026Q', q), sn, CASE WHEN q > 2 THEN result END, CASE WHEN n % 3 = 2 THEN n END::double FROM (SELECT *, sn::bigint AS n FROM y)""",
)
def _(t: Tables):
    months, quarters = quality_sheets(t)
    return scores.service_quality(scores.year_from_months(months, quarters, "2025"), scores.year_from_quarters(quarters, "2026"))


@query(
    "m26_app_sales",
    """SELECT trim(vin) AS vin, store, team, strftime(sale_date, '%Y-%m-%d') AS sale_date, settle_price, coalesce(transfer_fee, 0) AS unit_profit FROM {sales}
       WHERE (team IS NULL OR team NOT IN ('调拨', '其他', '试驾'))""",
)
def _(t: Tables):
    raw = t.sales.withColumns({"vin": F.concat(F.lit(" "), "vin"), "settle_price": F.format_number("settle_price", 0), "unit_profit": F.col("transfer_fee")})
    return day_texts(app.app_sales(raw), "sale_date").select("vin", "store", "team", "sale_date", "settle_price", "unit_profit")


@query("m26_app_stock", "SELECT store, series, model, colour, stock_days, vehicle_status, strftime(arrival_date, '%Y-%m-%d') AS arrival_date FROM {stock}")
def _(t: Tables):
    return day_texts(app.app_stock(t.stock.withColumn("stock_days", F.col("stock_days").cast("string"))), "arrival_date")


@query(
    "m27_service_filters",
    """SELECT 'policies' AS kind, vin AS id, coalesce(sign(try_cast(premium AS double)), 0)::int AS n FROM {insurance_business}
       UNION ALL SELECT 'leads', buyer, year(receipt_date)::int FROM {used_cars} WHERE lead_by = 'S1'
       UNION ALL SELECT 'used', buyer, 0 FROM {used_cars} WHERE receipt_state = '已收款'""",
)
def _(t: Tables):
    source = F.when(F.col("lead_by") == "S1", F.lit("售前")).otherwise(F.lit("售后"))
    leads = t.used_cars.withColumns({"lead_source": source, "lead_date": F.date_format("receipt_date", "yyyy/MM/dd"), "op_time": F.col("receipt_date")})
    policies, ahead, used = sales.service_filters(t.insurance_business, leads, t.used_cars)
    return (
        policies.select(F.lit("policies").alias("kind"), F.col("vin").alias("id"), F.col("policy_count").alias("n"))
        .unionByName(ahead.select(F.lit("leads").alias("kind"), F.col("buyer").alias("id"), F.year("lead_date").alias("n")))
        .unionByName(used.select(F.lit("used").alias("kind"), F.col("buyer").alias("id"), F.lit(0).alias("n")))
    )


@query(
    "m28_unsold_locked",
    """SELECT store AS company, vin, CASE vehicle_status WHEN '在途' THEN '在途' ELSE '在库' END AS state FROM {stock}
       WHERE arrival_date IS NOT NULL""",
)
def _(t: Tables):
    raw = t.stock.withColumn("lock_date", F.col("arrival_date"))
    return dashboard.unsold_locked(raw, ["store", "vin", "vehicle_status"], ["company", "vin", "state"])


@query(
    "m29_sales_invoice",
    f"""WITH {PROFIT}, {ORDERS}, ids AS (SELECT vin, id_number FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY order_date DESC, id_number) AS rn FROM booked) WHERE rn = 1)
        SELECT p.vin, store, team, seller AS consultant, ids.id_number, round(sale_price, 2) + 0 AS sale_price, strftime(sale_date, '%Y-%m-%d') AS sale_date
        FROM profit p LEFT JOIN ids ON ids.vin = p.vin WHERE team <> '调拨' AND team <> ''""",
)
def _(t: Tables):
    out = day_texts(cents(sales.sales_invoice(profit_of(t), orders_of(t)), "sale_price"), "sale_date")
    return out.select("vin", "store", "team", "consultant", "id_number", "sale_price", "sale_date")

"""Business tables derived from the given tables.

Plain SQL that Spark and other engines read alike. ``{name}`` stands for a table. Amounts
are whole numbers taken with ``floor`` so that every engine gets the same doubles.
"""

_VIN = "concat('VIN', lpad(cast({0} AS string), 14, '0'))"


def _vin(key: str) -> str:
    return _VIN.format(key)


VIEWS = {
    "series_dim": """
        SELECT c_mktsegment AS series, min(concat('网络', cast(c_nationkey % 3 AS string))) AS network,
               concat('K', cast(length(c_mktsegment) AS string)) AS kind
        FROM {customer} WHERE c_mktsegment <> 'BUILDING' GROUP BY c_mktsegment""",
    "store_dim": """
        SELECT n_name AS store, r_name AS network, concat('D', cast(n_nationkey % 4 AS string)) AS district
        FROM {nation} JOIN {region} ON r_regionkey = n_regionkey""",
    "sales": f"""
        SELECT {_vin("o_orderkey")} AS vin, o_orderkey AS orderkey,
               CASE WHEN n_nationkey % 5 = 0 THEN '直播基地'
                    WHEN n_nationkey % 5 = 1 THEN concat('贵州', n_name) ELSE n_name END AS store,
               c_mktsegment AS series, concat('M', cast(o_orderkey % 7 AS string)) AS model,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE concat('T', cast(o_orderkey % 6 AS string)) END AS trim,
               concat('C', cast(o_orderkey % 4 AS string)) AS colour,
               CASE o_orderpriority WHEN '1-URGENT' THEN '调拨' WHEN '2-HIGH' THEN '展厅组'
                    WHEN '3-MEDIUM' THEN '其他' WHEN '5-LOW' THEN 'DCC组' END AS team,
               CASE WHEN o_orderkey % 3 = 0 THEN concat('B', cast(o_custkey % 100 AS string)) ELSE c_name END AS buyer,
               concat('S', cast(o_custkey % 50 AS string)) AS seller,
               concat('H', cast(o_custkey % 9 AS string)) AS host,
               cast(13000000000 + o_custkey AS string) AS phone1,
               CASE WHEN o_custkey % 2 = 0 THEN '' ELSE cast(15000000000 + o_custkey AS string) END AS phone2,
               concat('ID', cast(o_custkey AS string)) AS id_number,
               o_orderdate AS sale_date,
               CASE o_orderkey % 3 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate - INTERVAL '10' DAY
                    ELSE o_orderdate - INTERVAL '45' DAY END AS order_date,
               o_orderdate - INTERVAL '5' DAY AS stock_in_date,
               o_totalprice AS list_price, cast(floor(o_totalprice * 0.97) AS double) AS bare_price,
               cast(floor(o_totalprice * 0.95) AS double) AS invoice_price,
               cast(floor(o_totalprice * 0.9) AS double) AS settle_price,
               cast((o_orderkey % 4) * 1000 AS double) AS trade_in,
               cast(CASE o_orderkey % 8 WHEN 0 THEN 300 WHEN 1 THEN 0 WHEN 2 THEN 150 END AS double) AS transfer_fee,
               cast((o_orderkey % 5) * 100 AS double) AS ticket_amt, cast(o_orderkey % 2 AS double) AS ticket_fee,
               cast((o_orderkey % 3) * 50 AS double) AS voucher, cast((o_orderkey % 7) * 20 AS double) AS finance_deposit,
               cast(10 AS double) AS insurance_deposit, cast(NULL AS double) AS other_deposit,
               cast((o_orderkey % 6) * 30 AS double) AS advisor_fee, cast((o_orderkey % 9) * 15 AS double) AS plate_fee,
               cast(o_orderkey % 11 AS double) AS other_fee, cast(2000 AS double) AS deposit,
               CASE o_orderstatus WHEN 'F' THEN '全款' WHEN 'O' THEN '按揭' END AS mode
        FROM {{orders}} JOIN {{customer}} ON c_custkey = o_custkey JOIN {{nation}} ON n_nationkey = c_nationkey""",
    "decoration": f"""
        SELECT l_orderkey AS id, CASE WHEN l_linestatus = 'O' THEN 0 ELSE l_linenumber END AS out_id,
               concat('N', cast(l_orderkey * 10 + l_linenumber % 2 AS string)) AS order_no,
               CASE WHEN l_orderkey % 50 = 7 THEN NULL ELSE {_vin("l_orderkey")} END AS vin,
               CASE p_type WHEN 'ECONOMY' THEN concat('膜', p_name) WHEN 'SMALL' THEN concat('龙膜', p_name)
                    ELSE p_name END AS item,
               CASE l_returnflag WHEN 'R' THEN '已退货' WHEN 'A' THEN '正常' END AS item_state,
               CASE l_linenumber % 4 WHEN 0 THEN '新车销售' WHEN 1 THEN '客户增购' WHEN 2 THEN '独立销售'
                    ELSE '其他销售' END AS doc_type,
               CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_extendedprice END AS revenue,
               cast(floor(l_extendedprice * 0.6) AS double) AS cost, l_quantity AS labour_fee, l_quantity AS qty,
               CASE WHEN l_suppkey % 10 = 3 THEN NULL ELSE l_shipdate END AS receipt_date,
               l_shipdate - INTERVAL '1' DAY AS invoice_date,
               CASE WHEN l_suppkey % 17 = 5 THEN NULL ELSE concat('S', cast(l_suppkey % 50 AS string)) END AS seller,
               concat('NATION_', cast(l_suppkey % 25 AS string)) AS store,
               concat('B', cast(l_orderkey % 100 AS string)) AS buyer,
               cast(13000000000 + l_orderkey % 100 AS string) AS phone1
        FROM {{lineitem}} JOIN {{part}} ON p_partkey = l_partkey""",
    "package_sales": f"""
        SELECT {_vin("l_orderkey")} AS vin,
               CASE l_linenumber % 3 WHEN 0 THEN '保赔无忧' WHEN 1 THEN '终身保养A' ELSE concat('P', cast(l_suppkey % 5 AS string)) END AS package,
               CASE l_returnflag WHEN 'R' THEN '审批驳回' WHEN 'A' THEN '通过' END AS approval,
               CASE WHEN l_suppkey % 6 = 0 THEN '已退卡' WHEN l_suppkey % 6 = 1 THEN NULL ELSE '有效' END AS order_state,
               CASE WHEN l_quantity > 25 THEN '0' WHEN l_quantity > 20 THEN 'x' ELSE cast(l_linenumber AS string) END AS amount,
               l_linenumber AS times, cast(cast(l_quantity AS bigint) AS string) AS settle_cost
        FROM {{lineitem}}""",
    "vehicle_cost": f"""
        SELECT {_vin("l_orderkey")} AS vin, concat('NATION_', cast(l_suppkey % 25 AS string)) AS store,
               concat('P', cast(l_orderkey % 5000 AS string)) AS purchase_no,
               CASE l_linenumber % 3 WHEN 0 THEN '在库' WHEN 1 THEN '在途' ELSE NULL END AS vehicle_status,
               concat('1,', lpad(cast(l_partkey % 1000 AS string), 3, '0')) AS referral,
               cast(l_linenumber * 10 AS double) AS adjustment, cast(l_quantity AS double) AS gov_subsidy,
               cast(l_quantity * 2 AS double) AS insurance_rebate, cast(l_linenumber * 100 AS double) AS terminal_rebate,
               cast(-20 AS double) AS plate_cost, cast(l_suppkey AS double) AS other_cost,
               l_partkey AS tie, l_shipdate AS op_date
        FROM {{lineitem}}""",
    "loan_business": f"""
        SELECT {_vin("o_orderkey")} AS vin,
               CASE o_orderkey % 4 WHEN 0 THEN '厂家非贴息' WHEN 1 THEN '厂家贴息' WHEN 2 THEN '银行' END AS finance_channel,
               CASE o_orderkey % 3 WHEN 0 THEN '建行5免2' WHEN 1 THEN '普通' END AS finance_plan,
               concat(cast(12 * (1 + o_orderkey % 5) AS string), '期') AS term,
               concat(cast(o_orderkey % 10 AS string), '%') AS rebate_rate,
               cast(floor(o_totalprice) AS double) AS invoice_price, cast(floor(o_totalprice * 0.5) AS double) AS loan_amount,
               concat('1,', lpad(cast(o_orderkey % 1000 AS string), 3, '0')) AS finance_rebate,
               cast(o_orderkey % 500 AS double) AS factory_subsidy, cast(o_orderkey % 300 AS double) AS dealer_subsidy,
               cast((o_orderkey % 2) * 200 AS double) AS finance_fee, o_orderpriority AS fee_status
        FROM {{orders}}""",
    "bill_business": f"""
        SELECT concat('P', cast(o_orderkey % 5000 AS string)) AS purchase_no, {_vin("o_orderkey")} AS vin,
               concat('NATION_', cast(o_custkey % 25 AS string)) AS bill_store, o_orderdate AS issue_date,
               o_orderdate + INTERVAL '90' DAY AS due_date, cast(o_orderkey AS string) AS bill_no,
               CASE o_orderkey % 5 WHEN 0 THEN '光大银行成都分行' WHEN 1 THEN '招商银行' WHEN 2 THEN NULL
                    WHEN 3 THEN '某信用社' ELSE '中国工商银行' END AS bank,
               o_totalprice AS bill_amount, CASE o_orderstatus WHEN 'F' THEN '已清' WHEN 'O' THEN '未清' END AS cleared
        FROM {{orders}}""",
    "stock": f"""
        SELECT concat('P', cast(l_orderkey * 10 + l_linenumber AS string)) AS purchase_no, {_vin("l_orderkey")} AS vin,
               CASE l_suppkey % 5 WHEN 0 THEN '直播基地' ELSE concat('NATION_', cast(l_suppkey % 25 AS string)) END AS store,
               CASE l_suppkey % 6 WHEN 0 THEN 'MAKER' WHEN 1 THEN NULL WHEN 2 THEN 'SISTER' ELSE 'OUTSIDE' END AS supplier,
               CASE l_partkey % 5 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'FURNITURE'
                    WHEN 3 THEN 'MACHINERY' ELSE 'HOUSEHOLD' END AS series,
               concat('M', cast(l_partkey % 7 AS string)) AS model, concat('T', cast(l_partkey % 6 AS string)) AS trim,
               concat('C', cast(l_partkey % 4 AS string)) AS colour,
               cast(floor(l_extendedprice) AS double) AS settle_price, concat('E', cast(l_partkey AS string)) AS engine_no,
               concat('NATION_', cast(l_suppkey % 7 AS string)) AS source_store,
               CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_shipdate END AS arrival_date,
               l_shipdate - INTERVAL '20' DAY AS shipped_date,
               cast(l_quantity * 5 AS int) AS stock_days,
               CASE l_linenumber % 4 WHEN 0 THEN '在途' WHEN 1 THEN '未发' ELSE '在库' END AS vehicle_status,
               CASE l_returnflag WHEN 'R' THEN l_shipdate END AS invoice_date
        FROM {{lineitem}}""",
    "plan": """
        SELECT concat('P', cast(o_orderkey % 5000 AS string)) AS purchase_no,
               CASE WHEN o_custkey % 5 = 0 THEN '直播基地' ELSE concat('NATION_', cast(o_custkey % 25 AS string)) END AS store,
               CASE o_custkey % 3 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' ELSE 'FURNITURE' END AS series,
               concat('M', cast(o_orderkey % 7 AS string)) AS model, o_orderkey AS plan_id,
               CASE WHEN o_orderkey % 2 = 0 THEN 'SISTER' ELSE 'MAKER' END AS supplier
        FROM {orders}""",
    "order_business": f"""
        SELECT {_vin("o_orderkey")} AS vin, o_orderdate AS order_date,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate - INTERVAL '3' DAY END AS deposit_date,
               CASE o_orderkey % 3 WHEN 0 THEN '待收款' WHEN 1 THEN '已收' END AS deposit_state,
               CASE o_orderkey % 5 WHEN 0 THEN '待审核' ELSE '审核通过' END AS approval,
               concat('S', cast(o_custkey % 50 AS string)) AS seller,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + INTERVAL '7' DAY END AS sale_date,
               cast(o_orderkey % 7 * 500 AS double) AS deposit,
               CASE WHEN c_nationkey % 5 = 0 THEN '直播基地' ELSE concat('NATION_', cast(c_nationkey AS string)) END AS store,
               concat('G', cast(o_orderkey % 3 AS string)) AS team, c_mktsegment AS series,
               concat('C', cast(o_orderkey % 4 AS string)) AS colour, concat('M', cast(o_orderkey % 7 AS string)) AS model,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE concat('T', cast(o_orderkey % 6 AS string)) END AS trim,
               c_name AS buyer, concat('ID', cast(o_custkey AS string)) AS id_number,
               cast(13000000000 + o_custkey AS string) AS phone1,
               CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE cast(15000000000 + o_custkey AS string) END AS phone2,
               o_orderkey % 10 = 9 AS voided
        FROM {{orders}} JOIN {{customer}} ON c_custkey = o_custkey""",
    "deals": """
        SELECT c_custkey AS id, concat(cast(13000000000 + c_custkey AS string), '.0') AS phone1,
               CASE WHEN c_custkey % 2 = 0 THEN '' ELSE cast(15000000000 + c_custkey AS string) END AS phone2,
               concat('H', cast(c_custkey % 9 AS string)) AS host, c_mktsegment AS series, c_name AS buyer,
               concat('NATION_', cast(c_nationkey AS string)) AS order_store
        FROM {customer} WHERE c_acctbal > 0""",
    "unsold": """
        SELECT c_custkey AS id, cast(13000000000 + c_custkey AS string) AS phone1,
               CASE WHEN c_custkey % 2 = 0 THEN '0' ELSE cast(15000000000 + c_custkey AS string) END AS phone2,
               concat('U', cast(c_custkey % 9 AS string)) AS host, c_mktsegment AS series, c_name AS buyer,
               concat('NATION_', cast(c_nationkey AS string)) AS order_store
        FROM {customer} WHERE c_acctbal < 2000""",
    "void_business": """
        SELECT CASE WHEN o_custkey % 5 = 0 THEN '直播基地' ELSE concat('NATION_', cast(o_custkey % 25 AS string)) END AS store,
               concat('G', cast(o_orderkey % 3 AS string)) AS channel, concat('S', cast(o_custkey % 50 AS string)) AS seller,
               o_orderdate AS order_date, CASE o_custkey % 3 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' ELSE 'FURNITURE' END AS series,
               concat('C', cast(o_orderkey % 4 AS string)) AS colour, concat('M', cast(o_orderkey % 7 AS string)) AS model,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE concat('T', cast(o_orderkey % 6 AS string)) END AS trim,
               concat('B', cast(o_orderkey AS string)) AS buyer,
               CASE o_orderkey % 4 WHEN 0 THEN '重复录入' WHEN 1 THEN '客户原因' WHEN 2 THEN '错误录入' END AS void_type,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate + INTERVAL '12' DAY END AS void_date
        FROM {orders}""",
    "invoices": f"""
        SELECT {_vin("l_orderkey")} AS vin, CASE WHEN l_linenumber % 2 = 0 THEN '车辆销售单' ELSE '其他单' END AS doc_kind,
               l_shipdate AS download_time, concat('NATION_', cast(l_suppkey % 25 AS string)) AS invoice_store
        FROM {{lineitem}}""",
    "used_cars": f"""
        SELECT concat('NATION_', cast(l_suppkey % 25 AS string)) AS store, l_extendedprice AS deal_price,
               cast(cast(l_quantity AS bigint) AS string) AS other_fee, concat('S', cast(l_suppkey % 50 AS string)) AS lead_by,
               concat('B', cast(l_orderkey % 100 AS string)) AS buyer, concat('M', cast(l_partkey % 7 AS string)) AS model,
               l_shipdate AS receipt_date,
               CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE {_vin("l_orderkey")} END AS trade_in_vin,
               CASE l_returnflag WHEN 'R' THEN '未收款' ELSE '已收款' END AS receipt_state
        FROM {{lineitem}}""",
    "transfer_business": f"""
        SELECT {_vin("l_orderkey")} AS vin, l_shipdate AS settle_date,
               concat('NATION_', cast(l_suppkey % 25 AS string)) AS out_store,
               concat('NATION_', cast(l_partkey % 25 AS string)) AS pay_store,
               CASE WHEN l_linenumber % 2 = 0 THEN concat('车 型 ', cast(l_partkey AS string)) ELSE cast(l_partkey AS string) END AS vehicle_info
        FROM {{lineitem}}""",
    "vat_rules": """
        SELECT concat(c_mktsegment, 'M1') AS match_key, '170000' AS cap_price, '100' AS deduction, '1996-01-01' AS start_date
        FROM {customer} GROUP BY c_mktsegment
        UNION ALL SELECT concat(c_mktsegment, 'M1'), '190000', '250', '1998-06-01' FROM {customer} GROUP BY c_mktsegment
        UNION ALL SELECT concat(c_mktsegment, 'M2'), '150000', '300', NULL FROM {customer} GROUP BY c_mktsegment
        UNION ALL SELECT concat(c_mktsegment, 'M3'), '1,0', '90', '1999/1/5' FROM {customer} GROUP BY c_mktsegment""",
    "insurance_business": f"""
        SELECT CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN '鼎和保险' ELSE concat('I', cast(o_custkey % 5 AS string)) END AS insurer,
               CASE o_orderkey % 5 WHEN 0 THEN '-100' WHEN 1 THEN '0' WHEN 2 THEN 'x' ELSE cast(o_orderkey AS string) END AS premium,
               {_vin("o_orderkey")} AS vin, o_orderdate AS policy_date,
               CASE WHEN o_custkey % 5 = 0 THEN '直播基地' WHEN o_custkey % 5 = 1 THEN '贵州店' ELSE concat('NATION_', cast(o_custkey % 25 AS string)) END AS store,
               CASE o_custkey % 3 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' ELSE 'FURNITURE' END AS series,
               CASE o_orderkey % 6 WHEN 0 THEN '1000' WHEN 1 THEN '950' ELSE '1130.0' END AS compulsory_premium,
               concat('S', cast(o_custkey % 50 AS string)) AS staff,
               CASE o_orderkey % 7 WHEN 0 THEN '营运' ELSE '普通' END AS business_source
        FROM {{orders}}""",
    "protection_docs": f"""
        SELECT CASE o_orderkey % 5 WHEN 0 THEN '售后' ELSE '售前' END AS department,
               CASE o_orderkey % 7 WHEN 0 THEN '失效' ELSE '生效' END AS state,
               c_name AS buyer, {_vin("o_orderkey")} AS vin, c_mktsegment AS series,
               o_orderdate AS product_sale_date,
               CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN o_orderdate + INTERVAL '4' DAY ELSE o_orderdate - INTERVAL '120' DAY END AS invoice_date,
               CASE WHEN o_orderkey % 2 = 0 THEN '畅行+终身版' ELSE '标准版' END AS version,
               o_totalprice AS invoice_price, CASE o_orderkey % 2 WHEN 0 THEN '新车' ELSE '次新车' END AS stage,
               '燃油' AS vehicle_kind, cast(floor(o_totalprice * 0.02) AS double) AS product_amount,
               cast(floor(o_totalprice * 0.01) AS double) AS cost,
               CASE WHEN c_nationkey % 5 = 0 THEN '直播基地' WHEN c_nationkey % 5 = 1 THEN '贵州店' ELSE concat('NATION_', cast(c_nationkey AS string)) END AS store,
               concat('网络', cast(c_nationkey % 2 AS string)) AS network,
               CASE o_orderkey % 11 WHEN 0 THEN '无效' ELSE '有效' END AS validity
        FROM {{orders}} JOIN {{customer}} ON c_custkey = o_custkey""",
    "protection_prices": """
        SELECT CASE WHEN p_partkey % 2 = 0 THEN '贵州' ELSE '成都' END AS region,
               concat('网络', cast(p_partkey % 11 % 2 AS string)) AS network,
               CASE WHEN p_partkey % 7 < 4 THEN '新车' ELSE '次新车' END AS stage,
               CASE p_partkey % 3 WHEN 0 THEN '0-10万' WHEN 1 THEN '15-20万' ELSE '35-40万' END AS price_band,
               CASE WHEN p_partkey % 13 < 7 THEN '畅行版' ELSE '标准版' END AS spec, '燃油' AS vehicle_kind,
               CASE p_partkey % 5 WHEN 0 THEN '1995-01-01' WHEN 1 THEN '1997-06-01' WHEN 2 THEN '1999-03-01'
                    WHEN 3 THEN '2000/1/1' ELSE '1996-01-01' END AS valid_from,
               CASE p_partkey % 5 WHEN 0 THEN '1997-12-31' WHEN 1 THEN '1999-05-01' WHEN 2 THEN '1999-04-01'
                    WHEN 3 THEN '2000-01-01' ELSE '2001-01-01' END AS valid_to,
               cast(min(100 + p_partkey % 5 * 50 + p_partkey % 11) AS double) AS cost
        FROM {part}
        GROUP BY p_partkey % 2, p_partkey % 11 % 2, CASE WHEN p_partkey % 7 < 4 THEN '新车' ELSE '次新车' END,
                 p_partkey % 3, CASE WHEN p_partkey % 13 < 7 THEN '畅行版' ELSE '标准版' END, p_partkey % 5""",
    "terminal_vins": f"""
        SELECT DISTINCT {_vin("l_orderkey")} AS vin FROM {{lineitem}} WHERE l_returnflag = 'A'""",
    "film_push": f"""
        SELECT concat('NATION_', cast(l_suppkey % 25 AS string)) AS store, {_vin("l_orderkey")} AS vin,
               CASE l_linenumber % 5 WHEN 0 THEN 'bad' ELSE replace(cast(l_shipdate AS string), '-', '/') END AS push_date,
               CASE l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE cast(l_linenumber * 150 AS string) END AS commission,
               CASE l_suppkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE 'G' END AS gift
        FROM {{lineitem}}""",
}
VIEWS = {name: text.replace("{{", "{").replace("}}", "}") for name, text in VIEWS.items()}

"""Scalar functions over text forms made from the given columns."""

from pyspark.sql import functions as F

from motorledger import values as V
from motorledger.functions import classes, dates, nulls, numbers, text
from motorledger.operators.columns import alias, relabel
from motorledger.queries.registry import Tables, query

DAY = "yyyy-MM-dd"

# texts as they arrive, one per order; both engines read this text
RAW = {
    "number": """SELECT o_orderkey AS id, CASE o_orderkey % 7 WHEN 0 THEN cast(o_totalprice AS string) WHEN 1 THEN '1,234.5'
        WHEN 2 THEN '' WHEN 3 THEN 'nan' WHEN 4 THEN ' -12.5 ' WHEN 5 THEN '12abc' END AS raw FROM {orders}""",
    "percent": "SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN concat(cast(o_orderkey % 100 AS string), '%') WHEN 1 THEN 'x%' END AS raw FROM {orders}",
    "term": """SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN 'None' WHEN 1 THEN '36,24' WHEN 2 THEN '12期' WHEN 3 THEN '48.0'
        WHEN 4 THEN cast(o_orderkey % 60 AS string) END AS raw FROM {orders}""",
    "phone": """SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN '13800.0' WHEN 3 THEN ' 139001 '
        WHEN 4 THEN 'abc' END AS raw FROM {orders}""",
    "day": """SELECT o_orderkey AS id, o_orderdate AS moment, CASE o_orderkey % 7
        WHEN 0 THEN concat(cast(year(o_orderdate) AS string), '/', cast(month(o_orderdate) AS string), '/', cast(day(o_orderdate) AS string))
        WHEN 1 THEN cast(o_orderdate AS string) WHEN 2 THEN 'not a day'
        WHEN 3 THEN concat(cast(year(o_orderdate) AS string), '年', cast(month(o_orderdate) AS string), '月', cast(day(o_orderdate) AS string), '日')
        WHEN 4 THEN concat(cast(year(o_orderdate) AS string), '年', cast(month(o_orderdate) AS string), '月')
        WHEN 5 THEN concat(cast(year(o_orderdate) AS string), lpad(cast(month(o_orderdate) AS string), 2, '0')) END AS raw FROM {orders}""",
    "dates": """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END AS a,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL '12' HOUR
             WHEN o_orderkey % 3 = 1 THEN o_orderdate - INTERVAL '40' DAY ELSE o_orderdate - INTERVAL '200' DAY END AS b FROM {orders}""",
    "words": """SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN '光大银行中信' WHEN 1 THEN '招商银行  KM' WHEN 2 THEN 'Han PLUS 500km e2'
        WHEN 3 THEN 'nan' WHEN 4 THEN ' two  words here ' END AS raw FROM {orders}""",
}


def raw(t: Tables, name: str):
    return t.sql(RAW[name])


def _as(name: str, body: str) -> str:
    return f"WITH r AS ({RAW[name]}) {body}"


@query(
    "x1_to_number",
    _as("number", """SELECT id,
        CASE id % 7 WHEN 0 THEN cast(raw AS double) WHEN 4 THEN -12.5 ELSE 0 END AS as_is,
        CASE id % 7 WHEN 0 THEN cast(raw AS double) WHEN 4 THEN -12.5 WHEN 1 THEN 1234.5 ELSE 0 END AS no_commas FROM r"""),
)
def _(t: Tables):
    return raw(t, "number").select(
        "id", numbers.to_number("raw").alias("as_is"), numbers.to_number("raw", "strip_commas").alias("no_commas")
    )


@query("x2_percent_to_fraction", _as("percent", "SELECT id, CASE WHEN id % 3 = 0 THEN (id % 100) / 100.0 END::double AS fraction FROM r"))
def _(t: Tables):
    return raw(t, "percent").select("id", numbers.percent_to_fraction("raw").alias("fraction"))


@query("x3_strip_cjk", _as("term", "SELECT id, regexp_replace(raw, '[一-龥]', '', 'g') AS term FROM r"))
def _(t: Tables):
    return raw(t, "term").select("id", numbers.strip_cjk("raw").alias("term"))


@query(
    "x4_loan_term",
    _as("term", "SELECT id, concat(CASE id % 6 WHEN 1 THEN 36 WHEN 3 THEN 48 WHEN 4 THEN id % 60 ELSE 0 END, '期') AS term FROM r"),
)
def _(t: Tables):
    return raw(t, "term").select("id", numbers.loan_term("raw").alias("term"))


@query("x5_phone_text", _as("phone", "SELECT id, CASE id % 6 WHEN 2 THEN '13800' WHEN 3 THEN '139001' WHEN 4 THEN 'abc' ELSE '' END AS phone FROM r"))
def _(t: Tables):
    return raw(t, "phone").select("id", numbers.phone_text("raw").alias("phone"))


@query("x6_sign_flag", "SELECT vin, coalesce(sign(try_cast(premium AS double)), 0)::int AS flag FROM {insurance_business}")
def _(t: Tables):
    return t.insurance_business.select("vin", numbers.sign_flag("premium").alias("flag"))


@query("x7_alias_values", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' ELSE o_orderstatus END AS o_orderstatus, CASE o_orderpriority WHEN '5-LOW' THEN 'low' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def _(t: Tables):
    return alias(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), {"F": "done", "5-LOW": "low"})


@query("x8_first_keyword", _as("words", "SELECT id, CASE id % 6 WHEN 0 THEN '光大' WHEN 1 THEN '招商' ELSE raw END AS bank FROM r"))
def _(t: Tables):
    return raw(t, "words").select("id", text.bank_name("raw").alias("bank"))


@query("x9_after_first_blank", _as("words", "SELECT id, CASE WHEN instr(raw, ' ') > 0 THEN substr(raw, instr(raw, ' ') + 1) ELSE raw END AS rest FROM r"))
def _(t: Tables):
    return raw(t, "words").select("id", text.after_first("raw").alias("rest"))


@query("x10_suffix", "SELECT vin, right(vin, 6) AS vin6 FROM {sales}")
def _(t: Tables):
    return t.sales.select("vin", text.suffix("vin", 6).alias("vin6"))


@query(
    "x11_normalize_text",
    _as("words", """SELECT id, coalesce(replace(replace(replace(regexp_replace(lower(trim(raw)), '\\s+', ' ', 'g'), 'km', 'KM'), 'plus', 'Plus'), 'e2', 'E2'), '') AS label FROM r"""),
)
def _(t: Tables):
    return raw(t, "words").select("id", text.normalize_text("raw").alias("label"))


@query("x12_replace_all", "SELECT p_partkey, replace(replace(p_name, 'red ', ''), 'ring', 'loop') AS name FROM part")
def _(t: Tables):
    return t.part.select("p_partkey", text.replace_all("p_name", {"red ": "", "ring": "loop"}).alias("name"))


@query("x13_replace_regex", "SELECT vin, regexp_replace(version, '畅行.*', '畅行版') AS version FROM {protection_docs}")
def _(t: Tables):
    return t.protection_docs.select("vin", text.replace_regex("version", V.TRAVEL_PATTERN, V.TRAVEL_VERSION).alias("version"))


@query("x14_has_keyword", "SELECT id, item, CASE WHEN contains(item_state, '退') THEN '是' ELSE '否' END AS returned FROM {decoration}")
def _(t: Tables):
    return t.decoration.select("id", "item", text.has_keyword("item_state", "退").alias("returned"))


@query(
    "x15_digits_only",
    _as("number", """SELECT id, CASE id % 7 WHEN 0 THEN cast(raw AS double) WHEN 1 THEN 1234.5 WHEN 4 THEN 12.5 WHEN 5 THEN 12 ELSE 0 END::double AS digits,
        CASE id % 7 WHEN 0 THEN cast(raw AS double) WHEN 1 THEN 1234.5 WHEN 4 THEN -12.5 WHEN 5 THEN 12 ELSE 0 END::double AS signed FROM r"""),
)
def _(t: Tables):
    return raw(t, "number").select(
        "id", numbers.to_number("raw", "digits_only").alias("digits"),
        numbers.to_number("raw", "digits_only", keep_sign=True).alias("signed"),
    )


@query("x16_incentive_number", _as("number", "SELECT id, CASE id % 7 WHEN 0 THEN cast(raw AS double) WHEN 4 THEN -12.5 WHEN 2 THEN NULL WHEN 6 THEN NULL ELSE 0 END::double AS incentive FROM r"))
def _(t: Tables):
    return raw(t, "number").select("id", numbers.incentive_number("raw").alias("incentive"))


@query("x17_parse_timestamp", _as("day", "SELECT id, CASE WHEN id % 7 IN (0, 1, 3) THEN strftime(moment, '%Y-%m-%d %H:%M:%S') END AS parsed FROM r"))
def _(t: Tables):
    return raw(t, "day").select("id", F.date_format(dates.parse_ts("raw"), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query(
    "x18_parse_cn_date",
    _as("day", """SELECT id, CASE id % 7 WHEN 1 THEN strftime(moment, '%Y-%m-%d') WHEN 3 THEN strftime(moment, '%Y-%m-%d')
        WHEN 4 THEN strftime(date_trunc('month', moment), '%Y-%m-%d') END AS parsed FROM r"""),
)
def _(t: Tables):
    return raw(t, "day").select("id", F.date_format(dates.parse_cn_date("raw"), DAY).alias("parsed"))


@query("x19_month_start", _as("day", "SELECT id, CASE WHEN id % 7 NOT IN (2, 6) THEN strftime(date_trunc('month', moment), '%Y-%m-%d') END AS month FROM r"))
def _(t: Tables):
    return raw(t, "day").select("id", F.date_format(dates.month_start("raw"), DAY).alias("month"))


@query(
    "x20_month_end_from_texts",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 13 BETWEEN 1 AND 12 THEN strftime(last_day(make_date(year(o_orderdate), o_orderkey % 13, 1)), '%Y-%m-%d') END AS month_end FROM orders",
)
def _(t: Tables):
    year = F.concat(F.year("o_orderdate").cast("string"), F.lit("年"))
    month = F.concat((F.col("o_orderkey") % 13).cast("string"), F.lit("月份"))
    return t.orders.select("o_orderkey", F.date_format(dates.month_end_from(year, month), DAY).alias("month_end"))


@query("x21_month_end", "SELECT o_orderkey, strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end FROM orders")
def _(t: Tables):
    return t.orders.select("o_orderkey", F.date_format(dates.month_end("o_orderdate"), DAY).alias("month_end"))


@query("x22_excel_date", "SELECT o_orderkey, strftime(DATE '1899-12-30' + cast(45000 + o_orderkey % 900 AS int), '%Y-%m-%d') AS day FROM orders")
def _(t: Tables):
    serial = F.concat((45000 + F.col("o_orderkey") % 900).cast("string"), F.lit(".25"))
    return t.orders.select("o_orderkey", F.date_format(dates.excel_date(serial), DAY).alias("day"))


@query("x23_same_month", _as("dates", "SELECT id, CASE WHEN date_trunc('month', a) = date_trunc('month', b) THEN 1 ELSE 0 END AS same FROM r"))
def _(t: Tables):
    return raw(t, "dates").select("id", dates.same_month("a", "b").alias("same"))


@query(
    "x24_days_between",
    _as("dates", "SELECT id, cast(floor(epoch(a - b) / 86400) AS int) AS days, cast(floor(epoch(a - b) / 86400) AS int) + 1 AS counted FROM r"),
)
def _(t: Tables):
    return raw(t, "dates").select("id", dates.days_between("a", "b").alias("days"), dates.days_between("a", "b", inclusive=True).alias("counted"))


@query("x25_within_days", _as("dates", "SELECT id, CASE WHEN floor(epoch(a - b) / 86400) BETWEEN 0 AND 90 THEN '是' ELSE '否' END AS near FROM r"))
def _(t: Tables):
    return raw(t, "dates").select("id", dates.within_days("a", "b", 0, 90).alias("near"))


@query(
    "x26_within_months",
    _as("dates", "SELECT id, CASE WHEN a IS NULL OR b IS NULL THEN '缺少日期' WHEN a < b + INTERVAL 3 MONTH THEN '是' ELSE '否' END AS label FROM r"),
)
def _(t: Tables):
    return raw(t, "dates").select("id", dates.within_months("a", "b", 3).alias("label"))


@query("x27_later_date", _as("dates", "SELECT id, strftime(CASE WHEN b > a THEN b ELSE a END, '%Y-%m-%d %H:%M:%S') AS later FROM r"))
def _(t: Tables):
    return raw(t, "dates").select("id", F.date_format(dates.later_date("b", "a"), "yyyy-MM-dd HH:mm:ss").alias("later"))


@query("x28_format_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d') AS day FROM orders")
def _(t: Tables):
    return t.orders.select("o_orderkey", dates.fmt_date("o_orderdate").alias("day"))


@query(
    "x29_stock_age_class",
    """SELECT purchase_no, vin, CASE WHEN vehicle_status IN ('未发', '在途') THEN '未到库' WHEN stock_days >= 180 THEN '180天以上' WHEN stock_days >= 120 THEN '120-180天'
              WHEN stock_days >= 90 THEN '90-120天' WHEN stock_days >= 60 THEN '60-90天' WHEN stock_days >= 30 THEN '30-60天' ELSE '30天以下' END AS age FROM {stock}""",
)
def _(t: Tables):
    return t.stock.select("purchase_no", "vin", classes.stock_age_class("stock_days", "vehicle_status").alias("age"))


@query(
    "x30_price_band",
    """SELECT o_orderkey, CASE WHEN p < 0 THEN NULL WHEN p < 100000 THEN '0-10万' WHEN p < 150000 THEN '10-15万' WHEN p < 200000 THEN '15-20万' WHEN p < 250000 THEN '20-25万'
              WHEN p < 300000 THEN '25-30万' WHEN p < 350000 THEN '30-35万' ELSE '35-40万' END AS band FROM (SELECT o_orderkey, o_totalprice - 20000 AS p FROM orders)""",
)
def _(t: Tables):
    return t.orders.select("o_orderkey", classes.band(F.col("o_totalprice") - 20000, V.PRICE_EDGES, V.PRICE_LABELS).alias("band"))


@query(
    "x31_map_status",
    "SELECT vin, team, CASE WHEN team IS NULL THEN NULL WHEN team = '调拨' THEN '未发' WHEN team = '其他' THEN '在途' ELSE '在库' END AS status FROM {sales}",
)
def _(t: Tables):
    return t.sales.select("vin", "team", classes.map_status("team", {"调拨": "未发", "其他": "在途"}, "在库").alias("status"))


@query("x32_null_text", _as("words", "SELECT id, nullif(raw, 'nan') AS known, coalesce(nullif(raw, 'nan'), '') AS shown FROM r"))
def _(t: Tables):
    return raw(t, "words").select("id", nulls.null_text("raw").alias("known"), nulls.null_text("raw", to="").alias("shown"))


@query("x33_vat_tax", "SELECT o_orderkey, CASE WHEN m > 0 THEN round_even(m / 1.13::double * 0.13::double * 1.12::double, 2) ELSE 0 END AS tax FROM (SELECT o_orderkey, floor(o_totalprice) - 200000 AS m FROM orders)")
def _(t: Tables):
    return t.orders.select("o_orderkey", numbers.vat_tax(F.floor("o_totalprice").cast("double") - 200000).alias("tax"))


@query(
    "x34_finance_tax",
    """SELECT vin, round(factory_subsidy / 1.13::double * 0.13::double * 1.12::double + dealer_subsidy / 1.06::double * 0.06::double * 1.12::double, 6) AS tax FROM {loan_business}""",
)
def _(t: Tables):
    return t.loan_business.select("vin", F.round(numbers.finance_tax(F.col("factory_subsidy"), F.col("dealer_subsidy")), 6).alias("tax"))


@query("x35_valid_store", "SELECT vin, coalesce(trim(concat(' ', CASE WHEN store = '直播基地' THEN NULL ELSE store END)) IN ('贵州NATION_1', 'NATION_2'), false)::int AS ok FROM {sales}")
def _(t: Tables):
    store = F.concat(F.lit(" "), F.when(F.col("store") != "直播基地", F.col("store")))
    return t.sales.select("vin", classes.valid_store(store, ["贵州NATION_1", "NATION_2"]).cast("int").alias("ok"))


@query("x36_by_threshold", _as("dates", "SELECT id, CASE WHEN a < '1998-01-01' THEN 'early' ELSE 'late' END AS side FROM r"))
def _(t: Tables):
    return raw(t, "dates").select("id", dates.by_threshold("a", dates.when_at("1998-01-01"), F.lit("early"), F.lit("late")).alias("side"))


@query("x37_relabel", "SELECT vin, CASE WHEN series = 'BUILDING' AND trade_in = 1000 THEN 'BUILDING 2' ELSE series END AS series FROM {sales}")
def _(t: Tables):
    return relabel(t.sales.select("vin", "series", "trade_in"), "series", (F.col("series") == "BUILDING") & (F.col("trade_in") == 1000), "BUILDING 2").drop("trade_in")


@query(
    "x38_party_kind",
    """SELECT vin, CASE WHEN team = '调拨' THEN CASE WHEN buyer IN ('Customer#000000005') OR length(buyer) <= 5 THEN '内部调出' ELSE '外部调出' END END AS kind,
              CASE WHEN seller = 'S1' THEN '内部调入' WHEN seller <> 'S2' THEN '外部调入' END AS origin FROM {sales}""",
)
def _(t: Tables):
    return t.sales.select(
        "vin", classes.transfer_kind("buyer", "team", ["Customer#000000005"]).alias("kind"),
        classes.supplier_kind("seller", ["S1"], "S2").alias("origin"),
    )


@query("x39_date_label", _as("dates", "SELECT id, CASE WHEN a IS NULL THEN '日期为空' WHEN a > '1998-01-01' THEN '是' ELSE '否' END AS label FROM r"))
def _(t: Tables):
    return raw(t, "dates").select("id", dates.date_label("a", dates.when_at("1998-01-01")).alias("label"))


@query(
    "x40_cash_and_carry",
    """SELECT vin, CASE WHEN sale_date IS NOT NULL AND (deposit_date IS NULL OR deposit_state = '待收款') THEN '现定现交' END AS kind FROM {order_business}""",
)
def _(t: Tables):
    return t.order_business.select("vin", classes.cash_and_carry("deposit_date", "sale_date", "deposit_state").alias("kind"))


@query(
    "x41_film_class",
    _as("dates", """SELECT id, CASE WHEN a IS NULL THEN '未到店' WHEN f IS NULL OR f = 0 THEN '是' ELSE '否' END AS free_film,
        CASE WHEN o > 0 THEN '是' ELSE '否' END AS other_upgrade, CASE WHEN o > 0 AND (f IS NULL OR f = 0) THEN '是' ELSE '否' END AS other_only
        FROM (SELECT id, a, CASE WHEN id % 4 = 0 THEN NULL ELSE id % 4 - 1 END AS f, CASE WHEN id % 3 = 0 THEN NULL ELSE id % 3 - 1 END AS o FROM r)"""),
)
def _(t: Tables):
    df = raw(t, "dates").withColumns(
        {
            "f": F.when(F.col("id") % 4 != 0, (F.col("id") % 4 - 1).cast("string")),
            "o": F.when(F.col("id") % 3 != 0, (F.col("id") % 3 - 1).cast("string")),
        }
    )
    return df.select("id", *[c.alias(n) for n, c in classes.film_class("a", "f", "o").items()])

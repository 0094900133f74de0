"""Scans and sources."""

from datetime import datetime

from pyspark.sql import functions as F

from motorledger.operators.joins import left_lookup
from motorledger.queries.registry import Tables, query
from motorledger.session import shared_folder
from motorledger.sources import ledgers, pages, tables


@query("s1_projected_scan", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(t: Tables):
    return tables.scan_table(t.spark, t.path("orders"), ["o_orderkey", "o_custkey", "o_totalprice"])


@query("s2_whole_table_scan", "SELECT * FROM customer")
def _(t: Tables):
    return tables.scan_table(t.spark, t.path("customer"))


@query(
    "s3_scan_since_window",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
       WHERE o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 7 DAY""",
)
def _(t: Tables):
    recent = tables.scan_since(t.orders, "o_orderdate", as_of=datetime(2001, 8, 1, 9), days=7)
    return recent.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query(
    "s4_scan_in_lists",
    """SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
       WHERE l_returnflag IN ('R', 'A') AND l_linestatus IN ('O')""",
)
def _(t: Tables):
    cols = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    return tables.scan_in(t.lineitem.select(*cols), {"l_returnflag": ["R", "A"], "l_linestatus": ["O"]})


@query(
    "s5_mapped_load",
    """SELECT 'customer' AS source, c_custkey AS id, c_name AS name FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier""",
)
def _(t: Tables):
    mapping = t.spark.createDataFrame(
        [("customer", "c_custkey", "id"), ("customer", "c_name", "name"), ("customer", "gone", "x"),
         ("supplier", "s_suppkey", "id"), ("supplier", "s_name", "name")],
        "table_name string, field string, name string",
    )
    loaded = tables.load_mapped({"customer": t.customer, "supplier": t.supplier, "part": t.part}, mapping)
    parts = [df.withColumn("source", F.lit(n)).select("source", "id", "name") for n, df in loaded.items()]
    return parts[0].unionByName(parts[1])


@query("s6_csv_archive_scan", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def _(t: Tables):
    folder = shared_folder(t.spark, "archive")
    t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").write.option("header", True).csv(folder)
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string"
    return ledgers.read_csv_table(t.spark, folder, schema)


@query(
    "s7_ledger_directory",
    """SELECT c_name AS buyer, cast(c_acctbal AS varchar) AS amount, NULL AS note FROM customer WHERE c_acctbal >= 0
       UNION ALL SELECT c_name, NULL, c_mktsegment FROM customer WHERE c_acctbal < 0""",
)
def _(t: Tables):
    folder = shared_folder(t.spark, "ledgers")
    rich, poor = t.customer.where("c_acctbal >= 0"), t.customer.where("c_acctbal < 0")
    out = lambda df, name: df.write.option("header", True).csv(f"{folder}/{name}")
    out(rich.select(F.col("c_name").alias(" Buyer "), F.col("c_acctbal").alias("Amount")), "a")
    out(poor.select(F.col("c_mktsegment").alias("note"), F.col("c_name").alias("BUYER")), "b")
    return ledgers.read_ledger_dir(t.spark, folder, ["buyer", "amount", "note"]).select("buyer", "amount", "note")


@query(
    "s7_quoted_headers",
    """SELECT c_name || chr(10) || 'said "' || c_mktsegment || '", once' AS name, cast(c_acctbal AS varchar) AS amount, NULL AS phone FROM customer WHERE c_acctbal >= 0
       UNION ALL SELECT c_name, NULL, c_mktsegment || ',' || c_nationkey FROM customer WHERE c_acctbal < 0""",
)
def _(t: Tables):
    folder = shared_folder(t.spark, "quoted")
    said = F.concat("c_name", F.lit('\nsaid "'), "c_mktsegment", F.lit('", once'))
    out = lambda df, name: df.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}")
    out(t.customer.where("c_acctbal >= 0").select(said.alias("name, full"), F.col("c_acctbal").alias("Amount\n(net)"), F.lit("").alias(" ")), "a")
    out(t.customer.where("c_acctbal < 0").select(F.concat_ws(",", "c_mktsegment", "c_nationkey").alias('"Phone"'), F.col("c_name").alias("Name, Full ")), "b")
    found = ledgers.read_ledger_dir(t.spark, folder, ["name, full"], width=16)
    return found.select(F.col("`name, full`").alias("name"), F.col("`amount(net)`").alias("amount"), F.col('`"phone"`').alias("phone"))


@query(
    "s8_ledger_sheets",
    "SELECT c_name AS buyer, c_mktsegment AS sheet FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
)
def _(t: Tables):
    folder = shared_folder(t.spark, "sheets")
    named = t.customer.select(F.col("c_name").alias("buyer"), F.col("c_mktsegment").alias("sheet"))
    named.write.option("header", True).partitionBy("sheet").csv(folder)
    found = ledgers.read_ledger_dir(t.spark, folder, ["buyer"], sheets=["BUILDING", "MACHINERY", "ABSENT"])
    return found.select("buyer", "sheet")


@query(
    "s9_document_scan",
    "SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en'",
)
def _(t: Tables):
    folder = shared_folder(t.spark, "documents")
    t.documents.write.json(folder)
    return tables.read_documents(
        t.spark, folder, "doc_id bigint, text string, lang string, source string, n_chars bigint",
        ["doc_id", "lang", "n_chars"], F.col("lang") == "en",
    )


def event_pages(t: Tables):
    """Events as landed pages of a hundred records, in the three envelope forms."""
    record = F.struct("event_id", "user_id", "event_type", "value", F.struct(F.col("props").alias("raw")).alias("extra"))
    paged = (
        t.events.withColumn("page", F.floor(F.col("event_id") / 100))
        .groupBy("page").agg(F.collect_list(record).alias("rows"))
    )
    forms = [
        F.to_json(F.struct(F.struct(F.col("rows").alias("Model")).alias("Msg"))),
        F.to_json(F.struct(F.struct(F.col("rows").alias("list")).alias("Data"))),
        F.to_json(F.struct(F.struct(F.col("rows").alias("items")).alias("Data"))),
    ]
    page = F.when(F.col("page") % 3 == 0, forms[0]).when(F.col("page") % 3 == 1, forms[1]).otherwise(forms[2])
    return paged.select("page", page.alias("body"))


RECORD = "struct<event_id: bigint, user_id: bigint, event_type: string, value: double, extra: struct<raw: string>>"


@query("s10_page_landing", "SELECT event_id, user_id, event_type, value, props AS raw FROM events")
def _(t: Tables):
    rows = pages.explode_pages(event_pages(t), "body", RECORD)
    return rows.select("event_id", "user_id", "event_type", "value", F.col("extra.raw").alias("raw"))


@query(
    "s11_dimensions",
    """SELECT vin, store, network, district FROM {sales} s
       LEFT JOIN (SELECT store AS d_store, network, district FROM {store_dim}) d ON d.d_store = s.store""",
)
def _(t: Tables):
    return left_lookup(t.sales.select("vin", "store"), t.store_dim, ["store"])


@query(
    "s12_table_profile",
    """SELECT count(*) AS rows, 6 AS columns, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day,
              strftime(max(o_orderdate), '%Y-%m-%d') AS last_day FROM orders""",
)
def _(t: Tables):
    day = lambda c: F.date_format(f"o_orderdate_{c}", "yyyy-MM-dd")
    found = tables.profile_table(t.orders)
    return found.select("rows", "columns", day("min").alias("first_day"), day("max").alias("last_day"))


@query(
    "s13_month_backfill",
    """WITH m AS (SELECT strftime(unnest(generate_series(DATE '1998-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)), '%Y%m') AS month),
            o AS (SELECT strftime(o_orderdate, '%Y%m') AS month, count(*) AS n, sum(o_orderkey) AS keys
                  FROM orders WHERE o_orderdate >= '1998-01-01' AND o_orderdate < '2002-01-01' GROUP BY 1)
       SELECT m.month, coalesce(n, 0) AS rows, keys FROM m LEFT JOIN o USING (month)""",
)
def _(t: Tables):
    months = tables.month_partitions(t.spark, "1998-01-15", "2001-12-10")
    rows = tables.backfill(t.orders, "o_orderdate", "1998-01-15", "2001-12-10")
    counted = rows.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))
    return left_lookup(months, counted, ["month"]).select("month", F.coalesce("n", F.lit(0)).alias("rows"), "keys")

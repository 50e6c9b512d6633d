"""Projections, deduplication, mappings, files and workbooks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsettle.functions.money import quoted, rejected
from adsettle.functions.ports import port_column
from adsettle.operators.merge import union_all
from adsettle.operators.pages import counted_pages
from adsettle.operators.projection import (
    Field,
    bind,
    bind_files,
    fields,
    parse_projections,
    project,
)
from adsettle.operators.totals import (
    dedup_counts,
    describe_columns as describe,
    first_per_key,
    unique_keys,
)
from adsettle.plans import media
from adsettle.plans.batch import run_batch
from adsettle.plans.routing import (
    MONTH_ENTRIES,
    WEEK_ENTRIES,
    has_role,
    media_of,
    route,
    routed_entries,
)
from adsettle.plans.unite import unite_sheets
from adsettle.session import staging_path
from adsettle.sinks.tables import append_table, replace_table, write_pages, write_result
from adsettle.sinks.workbook import write_books
from adsettle.sources.landed import read_landed
from adsettle.sources.workbook import (
    first_sheets,
    fitting_files,
    list_files,
    list_sheets,
    read_sheets,
    sheet_headers,
)
from catalog import sources as S
from catalog.base import as_export, cents, query, table
from catalog.monthly import FOUR_SUM_SQL


# Deduplication and counts.


@query(
    """
SELECT l_suppkey, min(l_shipdate) AS shipped, min(l_returnflag) AS flag, count(*) AS n
FROM lineitem GROUP BY l_suppkey ORDER BY 1"""
)
def dedup_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A key and aggregates, grouped by whatever is no aggregate."""
    listed = parse_projections(
        '[["l_suppkey", null], ["any_value(l_shipdate)", "shipped"],'
        ' ["any_value(\\"l_returnflag\\")", "flag"], ["COUNT(*)", "n"]]'
    )
    return unique_keys(table(spark, folder, "lineitem"), listed)


@query(
    """
SELECT l_suppkey, min(l_partkey) AS l_partkey, min(l_returnflag) AS l_returnflag,
       min(l_linestatus) AS l_linestatus, min(l_shipdate) AS l_shipdate
FROM lineitem GROUP BY l_suppkey"""
)
def dedup_first_column(spark: SparkSession, folder: str) -> DataFrame:
    """One row per value of the first column."""
    columns = ["l_suppkey", "l_partkey", "l_returnflag", "l_linestatus", "l_shipdate"]
    return first_per_key(table(spark, folder, "lineitem").select(*columns))


@query(f"WITH {S.ACCOUNT_SQL} SELECT * FROM account")
def account_dim(spark: SparkSession, folder: str) -> DataFrame:
    return S.account(spark, folder)


@query(
    """
SELECT count(*) AS rows_before, count(DISTINCT l_partkey) AS rows_after FROM lineitem"""
)
def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_counts(table(spark, folder, "lineitem"), ["l_partkey"])


@query(
    f"""
SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name,
       MAP {{'BIGINT': 'bigint', 'INTEGER': 'int', 'DOUBLE': 'double', 'VARCHAR': 'string',
             'TIMESTAMP': 'timestamp_ntz'}}[column_type] AS column_type,
       (SELECT count(*) FROM orders) AS row_count
FROM (DESCRIBE SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                      CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, o_orderpriority
      FROM orders)"""
)
def describe_columns(spark: SparkSession, folder: str) -> DataFrame:
    return describe(table(spark, folder, "orders"))


@query(
    """
SELECT count(*) AS cells, count(*) FILTER (WHERE l_linenumber = 7) AS bad_total,
       count(*) FILTER (WHERE l_linenumber = 6) AS bad_refund FROM lineitem"""
)
def rejected_cells(spark: SparkSession, folder: str) -> DataFrame:
    """How many cells a lenient run leaves out, by column."""
    raw = S.export(spark, folder, "lineitem", S.QUTOUTIAO)
    return raw.agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(rejected(raw, "总消费")).alias("bad_total"),
        F.count_if(rejected(raw, "赔付充值")).alias("bad_refund"),
    )


# Projections and mappings.


@query(
    """
SELECT o_orderkey AS id, o_totalprice, o_totalprice - o_custkey AS "net amount",
       'it''s "x"' AS note FROM orders"""
)
def projection_json(spark: SparkSession, folder: str) -> DataFrame:
    listed = parse_projections(
        '[["\\"o_orderkey\\"", "id"], ["o_totalprice", null],'
        ' ["o_totalprice - \\"o_custkey\\"", "net amount"], ["\'it\'\'s \\"x\\"\'", "note"]]'
    )
    # Adjacent literals: Spark reads a doubled quote as one inside a text, like the SQL standard.
    return project(table(spark, folder, "orders"), listed)


@query(
    """
SELECT kind, count(*) AS n, count(DISTINCT id) AS ids, min(name) AS name
FROM (SELECT 'customer' AS kind, CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer
      UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name FROM supplier)
GROUP BY kind"""
)
def alias_columns(spark: SparkSession, folder: str) -> DataFrame:
    """One mapping over two exports that spell the same column differently."""
    wanted = fields({"id": ("账号ID", "账户ID"), "name": ("账号名称", "账户名称"), "kind": "kind"})
    one = as_export(
        table(spark, folder, "customer"),
        {"账号ID": "c_custkey", "账号名称": "c_name", "kind": "'customer'"},
    )
    two = as_export(
        table(spark, folder, "supplier"),
        {"账户名称": "s_name", "账户ID": "s_suppkey", "kind": "'supplier'"},
    )
    rows = union_all([bind(one, wanted), bind(two, wanted)])
    per_id = rows.groupBy("kind", "id").agg(
        F.count(F.lit(1)).alias("n"), F.min("name").alias("name")
    )
    return per_id.groupBy("kind").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("ids"), F.min("name").alias("name")
    )


@query(
    """
SELECT coalesce(CASE WHEN l_partkey % 3 <> 0 THEN 'k ' || l_linenumber END,
                'provider ' || l_suppkey) AS box, count(*) AS n FROM lineitem GROUP BY 1"""
)
def coalesced_column(spark: SparkSession, folder: str) -> DataFrame:
    """A column with a second one to fall back on."""
    raw = S.export(spark, folder, "lineitem", S.MONTH_GUANGDIANTONG)
    rows = bind(raw, [Field("box", ("k框", "服务商简称"), "coalesce")])
    return rows.groupBy("box").agg(F.count(F.lit(1)).alias("n"))


def _media_files(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Orders by priority as files of one medium; the second has other headers, the last no rows."""
    orders = table(spark, folder, "orders")
    spelled = {
        "customer": "o_orderstatus",
        "spend": "o_totalprice",
        "id": "o_custkey",
        "name": "concat('acct ', o_custkey)",
        "new": "o_orderpriority",
    }
    v2 = dict(zip(["客户名称", "花费", "账户ID", "账户名称", "新客"], spelled.values(), strict=True))
    v1 = dict(zip(["客户名称", "消费", "账户id", "账户名称", "平台新客"], spelled.values(), strict=True))

    def file(test: Column, headers: dict[str, str]) -> DataFrame:
        return as_export(orders.filter(test), headers)

    names = sorted(r[0] for r in orders.select("o_orderpriority").distinct().collect())
    out = {}
    for i, name in enumerate(names):
        test = F.col("o_orderpriority") == name
        out[name] = file(test & F.lit(i < len(names) - 1), v1 if i == 1 else v2)
    return out


@query(
    """
SELECT o_orderstatus AS 客户名称_原始, o_orderpriority AS file, count(*) AS n,
       round(sum(o_totalprice), 2) AS 消费
FROM (SELECT *, dense_rank() OVER (ORDER BY o_orderpriority) AS place FROM orders)
WHERE place <> 2 AND place < (SELECT count(DISTINCT o_orderpriority) FROM orders) GROUP BY ALL"""
)
def schema_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """The first file settles which spelling counts; files that differ or are empty are left out."""
    mapping, bound, _ = bind_files(_media_files(spark, folder), media.mappings_of("汇川"))
    rows = media.unify(bound, mapping)
    out = rows.groupBy("客户名称_原始", F.col("平台新客").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("消费").alias("消费")
    )
    return cents(out, "消费")


@query(
    """
SELECT o_orderpriority AS file, 'general 花费' AS mapping,
       CASE WHEN place = 2 OR place = max(place) OVER () THEN 'skipped' ELSE 'loaded' END AS status,
       CASE WHEN place = 2 OR place = max(place) OVER () THEN 0 ELSE c END AS n
FROM (SELECT o_orderpriority, count(*) AS c, row_number() OVER (ORDER BY o_orderpriority) AS place
      FROM orders GROUP BY o_orderpriority)"""
)
def load_report(spark: SparkSession, folder: str) -> DataFrame:
    """Per file: the mapping, whether it was loaded, and how many rows."""
    _, bound, outcome = bind_files(_media_files(spark, folder), media.mappings_of("汇川"))
    files = spark.createDataFrame(outcome, "file string, mapping string, status string")
    loaded = bound.groupBy(F.col("平台新客").alias("file")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return files.join(loaded, "file", "left").withColumn("n", F.coalesce("n", F.lit(0)))


# Landed files.


@query(
    """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, round(sum(o_totalprice), 2) AS total,
       count(DISTINCT o_custkey) AS accounts
FROM orders GROUP BY o_orderstatus"""
)
def multi_file_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as CSV files, one folder per status, read back together as text."""
    path = staging_path(spark, "csv")
    orders = table(spark, folder, "orders").withColumn("part", F.col("o_orderstatus"))
    orders.write.partitionBy("part").option("header", "true").csv(path)
    rows = read_landed(spark, f"{path}/part=*", "csv")
    per_account = rows.groupBy("o_orderstatus", "o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("double")).alias("total")
    )
    out = per_account.groupBy("o_orderstatus").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.count(F.lit(1)).alias("accounts")
    )
    return cents(out, "total")


@query("SELECT n2 AS customer, n3 AS code FROM (WITH " + S.ACCOUNT_SQL + " SELECT * FROM account)")
def result_write(spark: SparkSession, folder: str) -> DataFrame:
    """Chosen columns of a result as CSV with a header, read back."""
    path = staging_path(spark, "result")
    dimension = S.account(spark, folder).select(
        F.col("n2").alias("customer"), F.col("n3").alias("code")
    )
    write_result(dimension, path, "csv")
    return read_landed(spark, path, "csv")


@query(
    """
SELECT CAST(floor((row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
         l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_shipdate) - 1) / 9000) AS INTEGER)
         + 1 AS page,
       l_orderkey, l_extendedprice
FROM lineitem"""
)
def paged_write(spark: SparkSession, folder: str) -> DataFrame:
    """A result in global order as page folders of at most 9,000 rows, read back."""
    path = staging_path(spark, "paged")
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount"]
    order = [F.desc("l_extendedprice"), *ties, "l_tax", "l_shipdate"]
    rows = table(spark, folder, "lineitem").select("l_extendedprice", *ties, "l_tax", "l_shipdate")
    write_pages(rows, path, 9000, order)
    return spark.read.parquet(path).select("page", "l_orderkey", "l_extendedprice")


@query(
    """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier"""
)
def table_append(spark: SparkSession, folder: str) -> DataFrame:
    """A table created from one source, another appended by position."""
    path = staging_path(spark, "accounts")
    name = "accounts_" + path.rpartition("-")[2]
    first = table(spark, folder, "customer").selectExpr("string(c_custkey) AS id", "c_name AS name")
    more = table(spark, folder, "supplier").selectExpr("string(s_suppkey) AS key", "s_name AS who")
    replace_table(first, name, path)
    append_table(more, name)
    return spark.table(name)


# Workbooks.

_BOOK = {
    "订单": "o_orderkey",
    "账户ID": "o_custkey",
    "公司名称": "concat('<', o_orderpriority, '> & co')",
    "总花费(元)": "o_totalprice",
    "备注": "case when o_orderstatus = 'P' then null else o_orderstatus end",
}


def _order_books(spark: SparkSession, folder: str) -> str:
    """Orders as workbooks of three sheets, 2,000 rows to a sheet; returns their folder."""
    path = staging_path(spark, "books")
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        *[F.expr(e).alias(h) for h, e in _BOOK.items()],
    )
    paged, _, _ = counted_pages(rows, 6000, ["o_orderkey"])
    sheet = F.floor(F.col("row_index") % 6000 / 2000) + 1
    placed = paged.select(
        F.lit("orders").alias("_result"),
        F.concat(F.lit("快手-all/快手消耗 "), F.format_string("%05d", "page"), F.lit(".xlsx")).alias("_file"),
        F.concat(F.lit("表 "), sheet.cast("string")).alias("_sheet"),
        *_BOOK,
    )
    write_books(placed, path)
    return path


_SHEETS_SQL = """
SELECT CAST(floor(i / 6000) AS BIGINT) + 1 AS book, CAST(floor(i % 6000 / 2000) AS INTEGER) + 1
         AS sheet_no, o.*
FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) o"""


@query(
    f"""
SELECT '快手-all' AS entry, '快手消耗 ' || lpad(CAST(book AS VARCHAR), 5, '0') || '.xlsx'
         AS file_name, sheet_no, '表 ' || sheet_no AS sheet
FROM ({_SHEETS_SQL}) GROUP BY book, sheet_no"""
)
def sheet_list(spark: SparkSession, folder: str) -> DataFrame:
    """The sheets of every workbook of an entry."""
    files = list_files(spark, _order_books(spark, folder))
    sheets = list_sheets(files)
    return files.join(sheets, "path").select("entry", "file_name", "sheet_no", "sheet")


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS account,
       '<' || o_orderpriority || '> & co' AS company, o_totalprice AS amount,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS note FROM orders"""
)
def workbook_union(spark: SparkSession, folder: str) -> DataFrame:
    """Every sheet of every workbook, united: what was written comes back."""
    files = list_files(spark, _order_books(spark, folder))
    wanted = fields(
        {
            "account": ("账号ID", "账户ID"),
            "id": "订单",
            "note": "备注",
            "company": "公司名称",
            "amount": "总花费(元)",
        }
    )
    rows = read_sheets(list_sheets(files), wanted).drop("path", "sheet")
    return rows.withColumn("amount", F.col("amount").cast("double"))


@query(
    f"""
SELECT '快手消耗 ' || lpad(CAST(book AS VARCHAR), 5, '0') || '.xlsx' AS file_name,
       count(*) AS n, round(sum(o_totalprice), 2) AS amount
FROM ({_SHEETS_SQL}) WHERE sheet_no = 1 GROUP BY book"""
)
def workbook_first_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """The first sheet of each file, by position, under its own headers."""
    files = list_files(spark, _order_books(spark, folder))
    rows = read_sheets(first_sheets(list_sheets(files)))
    out = rows.groupBy("path").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("总花费(元)").cast("double")).alias("amount"),
    )
    return cents(
        out.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "n", "amount"),
        "amount",
    )


@query(
    f"""
SELECT '快手消耗 ' || lpad(CAST(book AS VARCHAR), 5, '0') || '.xlsx' AS file_name,
       'second' AS mapping, 'loaded' AS status
FROM ({_SHEETS_SQL}) GROUP BY book"""
)
def workbook_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Which mapping the files of a source settle on, from their headers alone."""
    files = list_files(spark, _order_books(spark, folder))
    heads = sheet_headers(list_sheets(files))
    mappings = {
        "first": fields({"id": "账户ID", "total": "消费"}),
        "second": fields({"id": ("账户ID", "账号ID"), "total": "总花费(元)"}),
    }
    accepted = fitting_files(heads, mappings)
    if accepted is None:
        raise ValueError("no mapping fits")
    return accepted[1].select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "mapping", "status"
    )


@query(
    """
SELECT CAST(o_custkey AS VARCHAR) AS id, min('<' || o_orderpriority || '> & co') AS "公司名称"
FROM orders GROUP BY o_custkey"""
)
def unite_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """All sheets projected, then one row per value of the first column."""
    path = _order_books(spark, folder)
    listed = parse_projections('[["\\"账户ID\\"", "id"], ["\\"公司名称\\"", null]]')
    return unite_sheets(spark, f"{path}/*/*.xlsx", listed)


@query(
    """
SELECT CAST(o_custkey AS VARCHAR) AS id, min(CAST(o_orderkey AS VARCHAR)) AS first_order,
       count(*) AS n FROM orders GROUP BY o_custkey"""
)
def unite_workbooks_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """All sheets, grouped by a key with aggregates of choice."""
    path = _order_books(spark, folder)
    unique = parse_projections(
        '[["\\"账户ID\\"", "id"], ["any_value(\\"订单\\")", "first_order"], ["COUNT(*)", "n"]]'
    )
    return unite_sheets(spark, f"{path}/*/*.xlsx", unique=unique)


@query(FOUR_SUM_SQL.replace("LEFT JOIN account ON k = id", "LEFT JOIN account ON k = id AND 1 = 0")
       + "SELECT * FROM out")
def settle_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """A whole monthly run: line items as workbooks of an entry, no account list, pages out."""
    base, out = staging_path(spark, "base"), staging_path(spark, "out")
    rows = S.export(spark, folder, "lineitem", S.MONTH_KUAISHOU)
    paged, _, _ = counted_pages(rows, 20_000)
    placed = paged.select(
        F.lit("lineitem").alias("_result"),
        F.concat(F.lit("快手-a/快手 "), F.col("page"), F.lit(".xlsx")).alias("_file"),
        F.concat(F.lit("s"), F.floor(F.col("row_index") % 20_000 / 8000)).alias("_sheet"),
        *[F.col(quoted(c)) for c in rows.columns],
    )
    write_books(placed, base)
    summary = run_batch(spark, base, out, "month", kind="parquet").first()
    if summary["status"] != "ok":
        raise ValueError(summary["message"])
    result = spark.read.parquet(f"{out}/output_month_快手-a").drop("page")
    return cents(result, "结算消耗", "框返花费(元)", "总消耗")


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS account, o_totalprice AS amount
FROM orders"""
)
def workbook_blank_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders from sheets with a blank row behind every third one: all come back."""
    path = staging_path(spark, "blank")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    blank = orders.filter("o_orderkey % 3 = 0").select(
        "o_orderkey", *[F.lit(None).cast(t).alias(c) for c, t in orders.dtypes[1:]]
    )
    both = orders.withColumn("blank", F.lit(0)).unionByName(blank.withColumn("blank", F.lit(1)))
    paged, _, _ = counted_pages(both, 5000, ["o_orderkey", "blank"])
    shown = F.when(F.col("blank") == 0, F.col("o_orderkey"))
    placed = paged.select(
        F.lit("orders").alias("_result"),
        F.concat(F.lit("快手-a/快手 "), F.col("page"), F.lit(".xlsx")).alias("_file"),
        F.lit("s").alias("_sheet"),
        shown.alias("订单"),
        F.col("o_custkey").alias("账户ID"),
        F.col("o_totalprice").alias("金额"),
    )
    write_books(placed, path)
    wanted = fields({"id": "订单", "account": "账户ID", "amount": "金额"})
    rows = read_sheets(list_sheets(list_files(spark, path)), wanted).drop("path", "sheet")
    return rows.withColumn("amount", F.col("amount").cast("double"))


# Entries and files by name.

_ENTRY = (
    "concat(case c_mktsegment when 'AUTOMOBILE' then '广点通-大端口' when 'BUILDING' then '广点通'"
    " when 'FURNITURE' then '快手大健康金牛全站-执象' when 'HOUSEHOLD' then '快手' else '其他' end,"
    " '-', c_nationkey)"
)


@query(
    f"""
SELECT entry, substr(entry, strpos(entry, '-') + 1) AS port,
       CASE WHEN starts_with(entry, '广点通-大端口') THEN 'guangdiantong_provider'
            WHEN starts_with(entry, '广点通') THEN 'guangdiantong'
            WHEN starts_with(entry, '快手') THEN 'kuaishou' END AS week_query,
       CASE WHEN starts_with(entry, '广点通-大端口') THEN 'guangdiantong_large'
            WHEN starts_with(entry, '广点通') THEN 'guangdiantong'
            WHEN starts_with(entry, '快手大健康金牛全站-执象') THEN 'kuaishou_ordered'
            WHEN starts_with(entry, '快手') THEN 'kuaishou' END AS month_query,
       count(*) AS n
FROM (SELECT {_ENTRY} AS entry FROM customer) GROUP BY entry"""
)
def entry_routing(spark: SparkSession, folder: str) -> DataFrame:
    """The query of every entry name, by longest registered beginning."""
    entry = F.col("entry")
    return (
        table(spark, folder, "customer")
        .select(F.expr(_ENTRY).alias("entry"))
        .groupBy("entry")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "entry",
            port_column(entry).alias("port"),
            route(entry, WEEK_ENTRIES).alias("week_query"),
            route(entry, MONTH_ENTRIES).alias("month_query"),
            "n",
        )
    )


_FILE = (
    "concat(case o_orderkey % 9 when 0 then '小红书' when 1 then '汇川-小红书' when 2 then '趣头条'"
    " when 3 then '综媒' when 4 then '趣头汇川' when 5 then '综媒趣头' when 6 then '快手'"
    " else o_orderstatus end, o_orderkey % 100, case when o_orderkey % 11 = 0 then '.XLSX'"
    " when o_orderkey % 13 = 0 then '.xls' else '.xlsx' end)"
)


@query(
    f"""
WITH f AS (SELECT {_FILE} AS name FROM orders),
g AS (SELECT name, lower(name) LIKE '%.xlsx' AS book, contains(name, '小红书') AS x,
             contains(name, '汇川') AS h, contains(name, '趣头') AS q, contains(name, '综媒') AS z
      FROM f)
SELECT medium, count(*) AS files FROM (
  SELECT '小红书' AS medium FROM g WHERE book AND x
  UNION ALL SELECT '汇川' FROM g WHERE book AND h
  UNION ALL SELECT '趣头条' FROM g WHERE book AND q AND NOT x AND NOT h
  UNION ALL SELECT '其他综媒' FROM g WHERE book AND z AND NOT x AND NOT h AND NOT q)
GROUP BY medium"""
)
def media_files(spark: SparkSession, folder: str) -> DataFrame:
    """How many files each medium gets by their names."""
    names = table(spark, folder, "orders").select(F.expr(_FILE).alias("file_name"))
    return (
        names.select(F.explode(media_of(F.col("file_name"))).alias("medium"))
        .groupBy("medium")
        .agg(F.count(F.lit(1)).alias("files"))
    )


@query(
    f"""
SELECT entry, CASE WHEN bool_or(lower(name) LIKE '%.xlsx' AND regexp_matches(name,
                     '小红书|汇川|趣头|综媒')) THEN 'media_merge'
                   WHEN starts_with(entry, '快手') THEN 'kuaishou' END AS query
FROM (SELECT (CASE WHEN o_custkey % 3 = 0 THEN '快手-' ELSE '其他-' END) || o_custkey AS entry,
             {_FILE} AS name FROM orders)
GROUP BY entry"""
)
def entry_autodetect(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly entries, where one file that names a medium decides."""
    files = table(spark, folder, "orders").select(
        F.expr("concat(case when o_custkey % 3 = 0 then '快手-' else '其他-' end, o_custkey)").alias(
            "entry"
        ),
        F.expr(_FILE).alias("file_name"),
    )
    return routed_entries(files, "month")


_WEEK_FILE = (
    "concat(case o_orderkey % 4 when 0 then '头条-' else '快手-' end, o_custkey % 5,"
    " case o_orderkey % 3 when 0 then '消耗' when 1 then '充值' else ' 共享钱包流水' end,"
    " o_orderkey, case when o_orderkey % 7 = 0 then '.XLSX' else '.xlsx' end)"
)


@query(
    f"""
SELECT entry, role, count(*) AS files FROM (
  SELECT unnest(['main', 'spend', 'recharge', 'wallet']) AS role,
         unnest(['', '消耗', '充值', '共享钱包']) AS word, name, substr(name, 1, 4) AS entry
  FROM (SELECT {_WEEK_FILE} AS name FROM orders))
WHERE regexp_matches(substr(name, 5), word || '.*\\.xlsx$')
GROUP BY entry, role"""
)
def file_roles(spark: SparkSession, folder: str) -> DataFrame:
    """How many files of each weekly entry play each role."""
    names = table(spark, folder, "orders").select(F.expr(_WEEK_FILE).alias("file_name"))
    entry, name = F.substring("file_name", 1, 4), F.col("file_name")
    roles = F.array(
        F.when(has_role(entry, name), "main"),
        *[F.when(has_role(entry, name, r), r) for r in ("spend", "recharge", "wallet")],
    )
    return (
        names.select(entry.alias("entry"), F.explode(F.array_compact(roles)).alias("role"))
        .groupBy("entry", "role")
        .agg(F.count(F.lit(1)).alias("files"))
    )

"""Monthly settlements, media merges and pages over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsettle.functions.money import money, net, or_zero
from adsettle.operators.merge import enrich, tagged_union
from adsettle.operators.pages import top_rows, with_pages
from adsettle.operators.totals import active_accounts as count_active
from adsettle.operators.totals import totals
from adsettle.plans import media, monthly
from adsettle.plans.monthly import CUSTOMER
from catalog import sources as S
from catalog.base import cents, query, table

CUSTOMER_SQL = """n2 AS "客户名称", n3 AS "客户编号", n4 AS "AE", n5 AS "销售",
       n7 AS "返点形式", n6 AS "返点比率", n8 AS "端口\""""
NO_CUSTOMER_SQL = ", ".join(f'CAST(NULL AS VARCHAR) AS "{c}"' for c in CUSTOMER.values())


def _toutiao_sql(customer: str, join: str) -> str:
    return f"""
WITH {S.ACCOUNT_SQL},
s AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS k, min('advertiser ' || l_orderkey) AS name,
         min('company ' || (l_orderkey % 89)) AS company,
         min(CASE WHEN l_linenumber = 2 THEN 'wallet ' || l_suppkey END) AS wallet,
         sum(coalesce(CASE WHEN l_linenumber = 4 THEN NULL ELSE l_extendedprice END, 0))
           - sum(coalesce(l_discount, 0)) AS settled,
         sum(l_extendedprice) AS total, min(l_returnflag) AS i1, min(l_linestatus) AS i2,
         min('agent ' || (l_suppkey % 5)) AS agent
  FROM lineitem GROUP BY l_orderkey)
SELECT {customer}, company AS "广告主公司名称", round(settled, 2) + 0.0 AS "结算消耗",
       k AS "账户ID", k AS "广告主账户id", name AS "广告主账户名称", wallet AS "共享子钱包名称",
       round(total, 2) + 0.0 AS "总消耗", i1 AS "结算一级行业", i2 AS "结算二级行业",
       agent AS "一级代理商账户名称"
FROM s {join}"""


@query(_toutiao_sql(CUSTOMER_SQL, "LEFT JOIN account ON k = id"))
def month_two_term(spark: SparkSession, folder: str) -> DataFrame:
    raw = S.export(spark, folder, "lineitem", S.MONTH_TOUTIAO)
    return cents(monthly.toutiao(raw, S.account(spark, folder)), "结算消耗", "总消耗")


@query(_toutiao_sql(NO_CUSTOMER_SQL, ""))
def month_no_account(spark: SparkSession, folder: str) -> DataFrame:
    raw = S.export(spark, folder, "lineitem", S.MONTH_TOUTIAO)
    return cents(monthly.toutiao(raw, None), "结算消耗", "总消耗")


_FUND_MINUS = (
    "- sum(l_tax) - sum(l_discount) - 0 - sum(l_linenumber) - sum(l_tax) - 0 - sum(1.5)"
    " - sum(l_quantity) - sum(l_discount)"
)
_FUND_PLUS = (
    "sum(l_extendedprice) + sum(l_quantity)"
    " + sum(coalesce(CASE WHEN l_linenumber = 2 THEN NULL ELSE l_tax END, 0))"
)


@query(
    f"""
WITH {S.ACCOUNT_SQL},
s AS (
  SELECT CAST(l_partkey AS VARCHAR) AS k, min('provider ' || l_suppkey) AS provider,
         min('acct ' || l_partkey) AS name,
         min(CASE WHEN l_partkey % 3 <> 0 THEN 'k ' || l_linenumber END) AS box,
         min('group ' || (l_partkey % 11)) AS grp, {_FUND_PLUS} {_FUND_MINUS} AS settled,
         sum(l_extendedprice) AS total
  FROM lineitem GROUP BY l_partkey)
SELECT {CUSTOMER_SQL}, name AS "账户名称", round(CAST(settled AS DOUBLE), 2) + 0.0 AS "结算消耗",
       k AS "账户ID", provider AS "服务商简称", box AS "k框", grp AS "广告主集团",
       round(total, 2) + 0.0 AS "总消耗"
FROM s LEFT JOIN account ON k = id"""
)
def month_3plus_9minus(spark: SparkSession, folder: str) -> DataFrame:
    raw = S.export(spark, folder, "lineitem", S.MONTH_GUANGDIANTONG)
    return cents(monthly.guangdiantong(raw, S.account(spark, folder)), "结算消耗", "总消耗")


@query(
    f"""
WITH {S.ACCOUNT_SQL},
s AS (
  SELECT CAST(l_partkey AS VARCHAR) AS k, min('acct ' || l_partkey) AS name,
         min(coalesce(CASE WHEN l_partkey % 3 <> 0 THEN 'k ' || l_linenumber END,
                      'provider ' || l_suppkey)) AS box,
         {_FUND_PLUS} {_FUND_MINUS} - sum(l_quantity) - sum(l_discount) AS settled
  FROM lineitem GROUP BY l_partkey)
SELECT k AS "账户ID", name AS "账户名称", n2 AS "客户名称", box AS "k框",
       round(CAST(settled AS DOUBLE), 2) + 0.0 AS "结算消耗"
FROM s LEFT JOIN account ON k = id"""
)
def month_3plus_11minus(spark: SparkSession, folder: str) -> DataFrame:
    raw = S.export(spark, folder, "lineitem", S.MONTH_GUANGDIANTONG)
    return cents(monthly.guangdiantong_large(raw, S.account(spark, folder)), "结算消耗")


FOUR_SUM_SQL = f"""
WITH {S.ACCOUNT_SQL},
s AS (
  SELECT CAST(l_partkey AS VARCHAR) AS k, min('company ' || (l_partkey % 89)) AS company,
         min(l_returnflag) AS kind, min(l_linestatus) AS i1,
         min(CASE WHEN l_linenumber = 1 THEN 'first' END) AS i2,
         min('cat ' || l_linenumber) AS cat, min('product ' || (l_partkey % 7)) AS product,
         sum(l_tax) AS frame, sum(l_extendedprice) AS total,
         sum(l_extendedprice) + sum(coalesce(CASE WHEN l_linenumber = 3 THEN NULL
             ELSE l_quantity END, 0)) + sum(l_discount) + sum(l_tax) AS settled
  FROM lineitem GROUP BY l_partkey),
out AS (
SELECT {CUSTOMER_SQL}, company AS "公司名称", round(settled, 2) + 0.0 AS "结算消耗",
       k AS "账户ID", kind AS "账户类型", i1 AS "一级行业", i2 AS "二级行业",
       product AS "产品名", cat AS "用户自选类目", CAST(NULL AS VARCHAR) AS "素材打标类目",
       round(frame, 2) + 0.0 AS "框返花费(元)", round(total, 2) + 0.0 AS "总消耗"
FROM s LEFT JOIN account ON k = id)"""


def _kuaishou(spark: SparkSession, folder: str) -> DataFrame:
    raw = S.export(spark, folder, "lineitem", S.MONTH_KUAISHOU)
    out = monthly.kuaishou(raw, S.account(spark, folder))
    return cents(out, "结算消耗", "框返花费(元)", "总消耗")


@query(FOUR_SUM_SQL + "SELECT * FROM out")
def month_four_sum(spark: SparkSession, folder: str) -> DataFrame:
    return _kuaishou(spark, folder)


@query(FOUR_SUM_SQL + 'SELECT * FROM out ORDER BY "结算消耗" DESC, "账户ID" NULLS LAST')
def month_ordered(spark: SparkSession, folder: str) -> DataFrame:
    raw = S.export(spark, folder, "lineitem", S.MONTH_KUAISHOU)
    out = monthly.kuaishou_ordered(raw, S.account(spark, folder))
    return cents(out, "结算消耗", "框返花费(元)", "总消耗")


@query(
    FOUR_SUM_SQL
    + 'SELECT "账户ID", "客户名称", "结算消耗" FROM out '
    + 'ORDER BY "结算消耗" DESC, "账户ID" NULLS LAST LIMIT 20'
)
def topk_settlement(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty largest settlements."""
    rows = _kuaishou(spark, folder).select("账户ID", "客户名称", "结算消耗")
    return top_rows(rows, 20, monthly.kuaishou_order())


@query(
    """
SELECT count(*) AS accounts FROM (
  SELECT l_partkey FROM lineitem
  WHERE coalesce(l_discount, 0) - coalesce(l_tax, 0) - 0.0 > 0.00001 GROUP BY l_partkey)"""
)
def active_accounts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_partkey", "l_discount", "l_tax")
    return count_active(rows, "l_partkey", ["l_discount"], ["l_tax"])


@query(
    """
SELECT CAST(l_suppkey AS VARCHAR) AS account,
       round(sum(coalesce(TRY_CAST(CASE WHEN l_linenumber = 7 THEN 'n/a'
                 ELSE CAST(l_extendedprice AS VARCHAR) END AS DOUBLE), 0)
           - coalesce(TRY_CAST(CASE WHEN l_linenumber = 6 THEN ''
                 ELSE CAST(l_tax AS VARCHAR) END AS DOUBLE), 0)), 2) + 0.0 AS net
FROM lineitem GROUP BY l_suppkey"""
)
def try_cast_net(spark: SparkSession, folder: str) -> DataFrame:
    """Text that is no number counts as nothing."""
    raw = S.export(spark, folder, "lineitem", S.QUTOUTIAO)
    value = net(
        [or_zero(money(raw, "总消费", lenient=True))],
        [or_zero(money(raw, "赔付充值", lenient=True))],
    )
    sums = totals(raw.withColumnRenamed("广告主id", "account"), ["account"], {"net": value})
    return cents(sums, "net")


# Media.

MEDIA_SQL = {
    "汇川": """
  SELECT 'client ' || (o_custkey % 4) AS 客户名称_原始,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS 消费,
         CAST(o_custkey AS VARCHAR) AS 账户id, 'acct ' || o_custkey AS 账户名称,
         o_orderpriority AS 平台新客, '汇川' AS data_source FROM orders""",
    "其他综媒": """
  SELECT c_mktsegment, c_acctbal, CAST(c_custkey AS VARCHAR), c_name,
         CAST(c_nationkey AS VARCHAR), '其他综媒' FROM customer""",
    "小红书": """
  SELECT '小红书', value, CAST(user_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type, '小红书'
  FROM events""",
    "趣头条": """
  SELECT 'advertiser ' || (l_suppkey % 6),
         (CASE WHEN l_linenumber = 7 THEN 0 ELSE l_extendedprice END)
           - (CASE WHEN l_linenumber = 6 THEN 0 ELSE l_tax END),
         CAST(l_suppkey AS VARCHAR), 'login ' || l_suppkey, NULL, '趣头条' FROM lineitem""",
}


def _merge_sql(names: list[str], account: bool) -> str:
    union = " UNION ALL ".join(MEDIA_SQL[n] for n in names)
    dims = "n2, n3, n4, n5, n6, n7, n8"
    join = "LEFT JOIN account ON 账户id = id"
    if not account:
        dims = ", ".join(f"CAST(NULL AS VARCHAR) AS n{i}" for i in range(2, 9))
        join = ""
    return f"""
WITH {S.ACCOUNT_SQL},
parts AS ({union}),
named AS (SELECT 客户名称_原始, 消费, 账户id, 账户名称, 平台新客,
                 data_source FROM parts),
joined AS (SELECT named.*, {dims} FROM named {join})
SELECT n2 AS "客户名称", n3 AS "客户编号", 客户名称_原始 AS "客户名称_原始", min(n4) AS "AE",
       min(n5) AS "销售", min(n7) AS "返点形式", min(n6) AS "返点比率", min(n8) AS "端口",
       round(sum(coalesce(消费, 0)), 2) + 0.0 AS "消费", 账户id AS "账户id",
       min(账户名称) AS "账户名称", min(平台新客) AS "平台新客"
       {', min(data_source) AS "数据源"' if len(names) > 1 else ""}
FROM joined GROUP BY 账户id, 客户名称_原始, n2, n3
ORDER BY "消费" DESC, 账户id, 客户名称_原始"""


def _parts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    exports = {
        "汇川": S.export(spark, folder, "orders", S.HUICHUAN),
        "其他综媒": S.export(spark, folder, "customer", S.OTHER_MEDIA),
        "小红书": S.export(spark, folder, "events", S.XIAOHONGSHU),
        "趣头条": S.export(spark, folder, "lineitem", S.QUTOUTIAO),
    }
    return {name: media.medium_part(raw, name) for name, raw in exports.items()}


@query(_merge_sql(list(MEDIA_SQL), account=True))
def media_merge_multi(spark: SparkSession, folder: str) -> DataFrame:
    return cents(media.media_merge(_parts(spark, folder), S.account(spark, folder)), "消费")


@query(_merge_sql(["汇川"], account=True))
def media_merge_single(spark: SparkSession, folder: str) -> DataFrame:
    parts = {"汇川": media.medium_part(S.export(spark, folder, "orders", S.HUICHUAN), "汇川")}
    return cents(media.media_merge(parts, S.account(spark, folder)), "消费")


@query(_merge_sql(list(MEDIA_SQL), account=False))
def media_merge_no_account(spark: SparkSession, folder: str) -> DataFrame:
    return cents(media.media_merge(_parts(spark, folder), None), "消费")


@query(
    f"""
WITH parts AS ({" UNION ALL ".join(MEDIA_SQL.values())})
SELECT data_source, 客户名称_原始, count(*) AS n,
       count(平台新客) AS with_new_customer,
       round(sum(coalesce(消费, 0)), 2) + 0.0 AS 消费
FROM parts GROUP BY data_source, 客户名称_原始"""
)
def media_union(spark: SparkSession, folder: str) -> DataFrame:
    """The tagged union of four unlike sources, summed up by tag."""
    rows = tagged_union(_parts(spark, folder), "data_source")
    out = rows.groupBy("data_source", "客户名称_原始").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("平台新客").alias("with_new_customer"),
        F.sum(or_zero(F.col("消费"))).alias("消费"),
    )
    return cents(out, "消费")


# Pages.

_ORDER = "ORDER BY o_totalprice DESC, o_orderkey"


@query(
    f"""
SELECT o_orderkey, row_number() OVER ({_ORDER}) - 1 AS row_index,
       CAST(floor((row_number() OVER ({_ORDER}) - 1) / 4000) AS BIGINT) + 1 AS page
FROM orders"""
)
def page_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The exact place and page of every row in a global order."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    paged = with_pages(rows, 4000, [F.desc("o_totalprice"), F.asc("o_orderkey")])
    return paged.select("o_orderkey", "row_index", "page")


@query(
    """
WITH n AS (SELECT count(*) AS n FROM lineitem)
SELECT page, least(4000, n - (page - 1) * 4000) AS page_rows
FROM n, (SELECT unnest(generate_series(1, CAST(ceil(n / 4000) AS BIGINT))) AS page FROM n)"""
)
def page_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Page sizes of a result that has no order; nothing is sorted."""
    paged = with_pages(table(spark, folder, "lineitem").select("l_orderkey"), 4000)
    return paged.groupBy("page").agg(F.count(F.lit(1)).alias("page_rows"))


@query(
    f"""
WITH {S.ACCOUNT_SQL}
SELECT coalesce(n2, '-') AS customer, count(*) AS accounts
FROM (SELECT DISTINCT l_suppkey FROM lineitem)
LEFT JOIN account ON CAST(l_suppkey AS VARCHAR) = CAST(id AS VARCHAR) GROUP BY 1"""
)
def string_key_join(spark: SparkSession, folder: str) -> DataFrame:
    """A numeric key meets the dimension's text ids."""
    keys = totals(table(spark, folder, "lineitem"), ["l_suppkey"], {"n": F.lit(1)})
    joined = enrich(keys, S.account(spark, folder), "l_suppkey", {"n2": "customer"})
    return joined.groupBy(F.coalesce("customer", F.lit("-")).alias("customer")).agg(
        F.count(F.lit(1)).alias("accounts")
    )

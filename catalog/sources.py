"""The driver's tables in the shape of platform exports, and the same as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adsettle.plans.dimension import MONTH_ACCOUNT, account_dimension
from catalog.base import as_export, table

# The account list: customers, and suppliers as a second sheet whose ids repeat customer ids.
CUSTOMER_SHEET = {
    "账号ID": "c_custkey",
    "媒体账户主体": "c_mktsegment",
    "客户名称": "case when c_custkey % 10 <> 3 then c_name end",
    "客户编号": "concat('C', c_custkey)",
    "AE": "concat('AE', c_nationkey)",
    "销售": "concat('S', c_nationkey % 7)",
    "返点比率": "c_nationkey % 5",
    "返点形式": "case when c_nationkey % 2 = 0 then 'cash' end",
    "端口": "c_mktsegment",
}
SUPPLIER_SHEET = {
    "账号ID": "s_suppkey",
    "媒体账户主体": "cast(null as string)",
    "客户名称": "s_name",
    "客户编号": "concat('D', s_suppkey)",
    "AE": "concat('AE', s_nationkey)",
    "销售": "cast(null as string)",
    "返点比率": "s_nationkey % 5",
    "返点形式": "'goods'",
    "端口": "cast(null as string)",
}

ACCOUNT_SQL = """
account AS (
  SELECT id, min(n1) AS n1, min(n2) AS n2, min(n3) AS n3, min(n4) AS n4, min(n5) AS n5,
         min(n6) AS n6, min(n7) AS n7, min(n8) AS n8
  FROM (
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS n1,
           CASE WHEN c_custkey % 10 <> 3 THEN c_name END AS n2, 'C' || c_custkey AS n3,
           'AE' || c_nationkey AS n4, 'S' || (c_nationkey % 7) AS n5,
           CAST(c_nationkey % 5 AS VARCHAR) AS n6,
           CASE WHEN c_nationkey % 2 = 0 THEN 'cash' END AS n7, c_mktsegment AS n8
    FROM customer
    UNION ALL
    SELECT CAST(s_suppkey AS VARCHAR), NULL, s_name, 'D' || s_suppkey, 'AE' || s_nationkey, NULL,
           CAST(s_nationkey % 5 AS VARCHAR), 'goods', NULL
    FROM supplier
  ) GROUP BY id
)"""


def account_sheets(spark: SparkSession, folder: str) -> DataFrame:
    customers = as_export(table(spark, folder, "customer"), CUSTOMER_SHEET)
    return customers.union(as_export(table(spark, folder, "supplier"), SUPPLIER_SHEET))


def account(spark: SparkSession, folder: str) -> DataFrame:
    return account_dimension(account_sheets(spark, folder), MONTH_ACCOUNT)


# Weekly exports.
FUND_TYPE = (
    "case when l_returnflag = 'R' then '虚拟金' when l_linenumber = 7 then null else '现金' end"
)
FUND_ACCOUNT = (
    "case when l_linestatus = 'F' and l_linenumber = 1 then '内部领用金账户'"
    " when l_linestatus = 'F' and l_linenumber = 2 then '专用赠送账户' else '普通账户' end"
)
WEEK_FUNDS = {
    "账户ID": "l_partkey",
    "账户名称": "concat('acct ', l_partkey % 97)",
    "账户总消耗": "l_discount",
    "总转入(元)": "case when l_linenumber = 6 then null else l_tax end",
    "总转出(元)": "l_discount",
    "资金类型": FUND_TYPE,
    "资金账户名称": FUND_ACCOUNT,
    "所属服务商UID": "l_suppkey",
}
WEEK_SPEND = {
    "账户ID": "l_partkey + 50",
    "公司名称": "concat('company ', l_partkey % 89)",
    "总花费(元)": "l_extendedprice",
    "框返花费(元)": "l_tax",
    "激励花费(元)": "l_discount",
    "平台激励花费(元)": "case when l_linenumber = 5 then null else l_quantity end",
}
WEEK_RECHARGE = {
    "账户ID": "user_id",
    "企业名称": "concat('firm ', user_id % 13)",
    "总金额": "value",
    "激励金额": "event_id % 5",
    "框返金额": "case when event_type = 'error' then null else '0.25' end",
    "活动框返金额": "'0'",
    "平台激励金额": "user_id % 3",
}
WEEK_TOUTIAO_SPEND = {
    "广告主账户id": "l_partkey + 50",
    "客户名称": "concat('client ', l_partkey % 83)",
    "一级代理商账户名称": "concat('agent ', l_suppkey % 5)",
    "非赠款消耗": "l_extendedprice",
    "返佣消耗": "l_tax",
}
WEEK_TRANSFERS = {
    "转账类型": "case event_type when 'error' then '退款' when 'purchase' then '加款'"
    " when 'signup' then '加款' else '其他' end",
    "转出方账户ID": "event_id % 100",
    "转入方账户ID": "user_id",
    "转出方客户名称": "concat('payer ', event_id % 100)",
    "转入方客户名称": "concat('payee ', user_id)",
    "业务平台": "concat('platform ', user_id % 4)",
    "总金额（元）": "value",
}
WEEK_WALLET = {
    "共享钱包ID": "o_custkey",
    "共享钱包名称": "concat('wallet ', o_custkey)",
    "业务线": "o_orderpriority",
    "总收入": "o_totalprice",
    "总支出": "o_custkey",
}

# Monthly exports.
MONTH_KUAISHOU = {
    "账户ID": "l_partkey",
    "公司名称": "concat('company ', l_partkey % 89)",
    "账户类型": "l_returnflag",
    "一级行业": "l_linestatus",
    "二级行业": "case when l_linenumber = 1 then 'first' end",
    "用户自选类目": "concat('cat ', l_linenumber)",
    "产品名": "concat('product ', l_partkey % 7)",
    "素材打标类目": "cast(null as string)",
    "框返花费(元)": "l_tax",
    "总花费(元)": "l_extendedprice",
    "现金花费(元)": "l_extendedprice",
    "信用花费(元)": "case when l_linenumber = 3 then null else l_quantity end",
    "前返花费(元)": "l_discount",
    "后返花费(元)": "l_tax",
}
_FUNDS = {
    "现金消耗（元）": "l_extendedprice",
    "信用金消耗（元）": "l_quantity",
    "赠送金消耗（元）": "case when l_linenumber = 2 then null else l_tax end",
    "红包封面消耗": "l_tax",
    "微信内购赠送金消耗": "l_discount",
    "微信内购快周转消耗": "'0'",
    "专用金消耗": "l_linenumber",
    "补偿虚拟金消耗": "l_quantity",
    "安卓定向应用金消耗": "l_tax",
    "TCC赠送金消耗（微信广告）": "cast(null as string)",
    "微信专用小游戏抵用金消耗": "'1.5'",
    "互选广告消耗": "l_discount",
    "流量主广告金消耗": "l_quantity",
    "短剧内购赠送金消耗": "l_discount",
}
MONTH_GUANGDIANTONG = {
    "账户ID": "l_partkey",
    "服务商简称": "concat('provider ', l_suppkey)",
    "账户名称": "concat('acct ', l_partkey)",
    "k框": "case when l_partkey % 3 <> 0 then concat('k ', l_linenumber) end",
    "广告主集团": "concat('group ', l_partkey % 11)",
    "总消耗": "l_extendedprice",
    **_FUNDS,
}
MONTH_TOUTIAO = {
    "广告主账户id": "l_orderkey",
    "广告主账户名称": "concat('advertiser ', l_orderkey)",
    "广告主公司名称": "concat('company ', l_orderkey % 89)",
    "共享子钱包名称": "case when l_linenumber = 2 then concat('wallet ', l_suppkey) end",
    "非赠款消耗": "case when l_linenumber = 4 then null else l_extendedprice end",
    "返佣消耗": "l_discount",
    "结算一级行业": "l_returnflag",
    "结算二级行业": "l_linestatus",
    "总消耗": "l_extendedprice",
    "一级代理商账户名称": "concat('agent ', l_suppkey % 5)",
}

# Media exports, each in another spelling.
XIAOHONGSHU = {"发生金额(元)": "value", "子账户名称": "user_id", "资金类型": "event_type"}
HUICHUAN = {
    "客户名称": "concat('client ', o_custkey % 4)",
    "消费": "case when o_orderstatus = 'P' then null else o_totalprice end",
    "账户id": "o_custkey",
    "账户名称": "concat('acct ', o_custkey)",
    "平台新客": "o_orderpriority",
}
QUTOUTIAO = {
    "广告主名称": "concat('advertiser ', l_suppkey % 6)",
    "总消费": "case when l_linenumber = 7 then 'n/a' else cast(l_extendedprice as string) end",
    "赔付充值": "case when l_linenumber = 6 then '' else cast(l_tax as string) end",
    "广告主id": "l_suppkey",
    "广告主账号": "concat('login ', l_suppkey)",
}
OTHER_MEDIA = {
    "客户名称": "c_mktsegment",
    "成本": "c_acctbal",
    "账号ID": "c_custkey",
    "账号名称": "c_name",
    "平台新客": "c_nationkey",
}


def export(
    spark: SparkSession, folder: str, name: str, headers: dict[str, str], typed: bool = False
) -> DataFrame:
    return as_export(table(spark, folder, name), headers, typed)

"""Hand-made rows for every null, tolerance, join and routing rule of the settlements."""

from __future__ import annotations

import pytest

from adsettle.operators.merge import enrich, spend_with_recharge
from adsettle.plans import media, monthly, weekly
from adsettle.plans.dimension import MONTH_ACCOUNT, WEEK_ACCOUNT, account_dimension


def table(spark, headers, rows):
    schema = ", ".join(f"`{h}` string" for h in headers)
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def account(spark):
    rows = [
        ["1", None, "c1", "code1", "ae", "s", "0.1", "cash", "p"],
        ["1", "owner1", None, "code1", None, "s", "0.1", "cash", "p"],
        ["2", "owner2", "c2", "code2", None, None, None, None, None],
        [None, "nobody", "nobody", None, None, None, None, None, None],
    ]
    return account_dimension(table(spark, MONTH_ACCOUNT.values(), rows))


def test_dimension(spark, account):
    got = {r.id: tuple(r)[1:4] for r in account.collect()}
    assert got["1"] == ("owner1", "c1", "code1") and got["2"][0] == "owner2" and len(got) == 3
    weekly_part = account_dimension(
        table(spark, WEEK_ACCOUNT.values(), [["1", "o", "c", "n"]]), WEEK_ACCOUNT
    )
    assert weekly_part.columns == ["id", "n1", "n2", "n3"]


W1 = ["账号ID", "账户名称", "账户总消耗", "总转入(元)", "总转出(元)", "资金类型", "资金账户名称", "所属服务商UID"]


def test_week_guangdiantong(spark, account):
    rows = [
        ["1", None, "10", "5", "2", "现金", "普通", None],
        ["1", "name", "0", "1", "0.5", "现金", "普通", "u"],
        ["1", "z", "7", "1", "1", "虚拟金", "普通", "a"],
        ["1", "z", "7", "1", "1", "现金", "内部领用金账户", "a"],
        ["1", "z", "7", "1", "1", "现金", "专用赠送账户", "a"],
        ["1", "z", "7", "1", "1", None, "普通", "a"],
        ["1", "z", "7", "1", "1", "现金", None, "a"],
        ["2", "two", "0.000005", "1", "1.000005", "现金", "普通", "b"],
        ["3", "three", None, "2", "1", "现金", "普通", "b"],
        ["4", "four", "4", None, "1", "现金", "普通", "b"],
        ["5", "five", None, None, "1", "现金", "普通", "b"],
        [None, "none", "1", "0", "0", "现金", "普通", "b"],
    ]
    raw = table(spark, W1, rows)
    out = weekly.guangdiantong(raw, account, "north")
    assert out.columns == ["媒体账户主体", "客户", "端口名称", "账号ID", "账户名称", "消耗", "充值"]
    assert rows_of(out) == sorted(
        [
            ("owner1", "c1", "north", "1", "name", 10.0, 3.5),
            (None, None, "north", "3", "three", None, 1.0),
            (None, None, "north", "4", "four", 4.0, None),
            (None, None, "north", None, "none", 1.0, 0.0),
        ],
        key=repr,
    )
    provider = weekly.guangdiantong_provider(raw, account, "north")
    assert provider.columns[5] == "所属服务商UID"
    assert {r["账号ID"]: r["所属服务商UID"] for r in provider.collect()}["1"] == "u"


def kuaishou_tables(spark):
    spend = table(
        spark,
        ["账户ID", "公司名称", "总花费(元)", "框返花费(元)", "激励花费(元)", "平台激励花费(元)"],
        [
            ["1", "one", "10", "1", "1", "1"],
            ["1", "one", "5", None, "0", "0"],
            ["2", "two", "3", "1", "1", "1"],
            ["4", "four", "2", "0", "0", "0"],
            [None, "null spend", "1", "0", "0", "0"],
        ],
    )
    recharge = table(
        spark,
        ["账户ID", "企业名称", "总金额", "激励金额", "框返金额", "活动框返金额", "平台激励金额"],
        [
            ["1", "firm one", "100", "1", "1", "1", "1"],
            ["3", "three", "5", "0", "0", "0", "0"],
            ["4", "f", "0.00002", "0", "0", "0", "0"],
            ["4", "f", "-0.00002", "0", "0", "0", "0"],
            [None, "null recharge", "9", "0", "0", "0", "0"],
        ],
    )
    return spend, recharge


def test_week_kuaishou(spark, account):
    out = weekly.kuaishou(*kuaishou_tables(spark), account, "south")
    assert rows_of(out) == sorted(
        [
            ("owner1", "c1", "south", "1", "one", 7.0, 96.0),
            (None, None, "south", "3", "three", 0.0, 5.0),
            (None, None, "south", "4", "four", 2.0, 0.0),
            (None, None, "south", None, "null spend", 1.0, 0.0),
            (None, None, "south", None, "null recharge", 0.0, 9.0),
        ],
        key=repr,
    )


def toutiao_tables(spark):
    spend = table(
        spark,
        ["广告主账户id", "客户名称", "一级代理商账户名称", "非赠款消耗", "返佣消耗"],
        [["1", "one", "agent", "10", "1"], ["5", "five", "agent", "1", "1"]],
    )
    transfers = table(
        spark,
        ["转账类型", "转出方账户ID", "转入方账户ID", "转出方客户名称", "转入方客户名称", "业务平台", "总金额（元）"],
        [
            ["加款", "9", "1", "payer", "payee", "plat", "4"],
            ["退款", "2", "9", "payer", "payee", "plat", "-3"],
            ["转账", "8", "8", "payer", "payee", "plat", "1000"],
            [None, "8", "8", "payer", "payee", "plat", "1000"],
        ],
    )
    wallet = table(
        spark,
        ["共享钱包ID", "共享钱包名称", "业务线", "总收入", "总支出"],
        [["1", "wallet", "line", "8", "2"], ["7", "empty", "line", "2", "2"]],
    )
    return spend, transfers, wallet


def test_week_toutiao_fan_out(spark, account):
    out = weekly.toutiao(*toutiao_tables(spark), account)
    assert out.columns == ["媒体账户主体", "客户", "账号ID", "账户名称", "端口名称", "消耗", "充值"]
    assert rows_of(out) == sorted(
        [
            ("owner1", "c1", "1", "one", "agent", 9.0, 4.0),
            ("owner1", "c1", "1", "one", "agent", 9.0, 6.0),
            ("owner2", "c2", "2", "payer", "plat", 0.0, -3.0),
        ],
        key=repr,
    )
    again = weekly.toutiao(*toutiao_tables(spark), account, regroup=True)
    assert ("owner1", "c1", "1", "one", "agent", 9.0, 10.0) in rows_of(again)
    assert len(rows_of(again)) == 2


def test_weekly_without_dimension(spark):
    out = weekly.toutiao(*toutiao_tables(spark), None)
    assert {tuple(r)[:2] for r in out.collect()} == {(None, None)}
    assert dict(out.dtypes)["客户"] == "string"


def test_merge_drops_rows_without_amounts(spark):
    spend = spark.createDataFrame([("a", 0.0), ("b", 1.0)], "k string, s double")
    recharge = spark.createDataFrame([("a", 0.000001), ("c", None)], "k string, r double")
    out = spend_with_recharge(spend, recharge, "k", [], "s", "r")
    assert rows_of(out) == [("b", 1.0, 0.0)]


def test_join_keys_meet_as_text(spark, account):
    df = spark.createDataFrame([(1,), (3,)], "id long")
    out = enrich(df, account, "id", {"n2": "客户名称"})
    assert rows_of(out) == [(1, "c1"), (3, None)]


def test_month_kuaishou(spark, account):
    headers = list(monthly.KUAISHOU.values())
    rows = [
        ["1", None, "t", "i1", None, "u", "p", "m", "1", "20", "10", None, "1", "2"],
        ["1", "co", None, "i1", "i2", None, "q", None, None, "5", "1", "1", "1", "1"],
        ["9", "x", None, None, None, None, None, None, None, None, None, None, None, None],
    ]
    raw = table(spark, headers, rows)
    out = monthly.kuaishou_ordered(raw, account)
    assert tuple(out.columns) == monthly.KUAISHOU_OUT
    first, second = out.collect()
    assert first.asDict() == {
        "客户名称": "c1", "客户编号": "code1", "公司名称": "co", "AE": "ae", "销售": "s",
        "返点形式": "cash", "返点比率": "0.1", "端口": "p", "结算消耗": 17.0, "账户ID": "1",
        "账户类型": "t", "一级行业": "i1", "二级行业": "i2", "产品名": "p", "用户自选类目": "u",
        "素材打标类目": "m", "框返花费(元)": 1.0, "总消耗": 25.0,
    }
    assert (second["账户ID"], second["结算消耗"], second["客户名称"]) == ("9", 0.0, None)


def test_month_guangdiantong(spark, account):
    powers = {h: str(2**i) for i, h in enumerate(monthly.GUANGDIANTONG_MONEY.values())}
    by_name = {n: float(powers[h]) for n, h in monthly.GUANGDIANTONG_MONEY.items()}
    row = {"账户ID": "1", "服务商简称": "prov", "账户名称": "n", "k框": None, "广告主集团": "g", "总消耗": "3", **powers}
    raw = table(spark, row.keys(), [row.values()])
    plus = by_name["现金消耗（元）"] + by_name["信用金消耗（元）"] + by_name["赠送金消耗（元）"]
    nine = sum(by_name.values()) - plus - by_name["补偿虚拟金消耗"] - by_name["互选广告消耗"]
    out = monthly.guangdiantong(raw, account).first()
    assert out["结算消耗"] == plus - nine and out["总消耗"] == 3.0 and out["k框"] is None
    large = monthly.guangdiantong_large(raw, account).first()
    assert tuple(large) == ("1", "n", "c1", "prov", 2 * plus - sum(by_name.values()))
    assert tuple(monthly.guangdiantong(raw, None).columns) == monthly.GUANGDIANTONG_OUT


def test_month_toutiao(spark, account):
    headers = list(monthly.TOUTIAO.values())
    raw = table(
        spark,
        headers,
        [
            ["2", "n", "co", None, "10", "3", "a", "b", "11", "ag"],
            ["2", "n", "co", "w", None, "1", "a", "b", None, "ag"],
        ],
    )
    out = monthly.toutiao(raw, account).first()
    assert tuple(out) == (
        "c2", "code2", "co", None, None, None, None, None, 6.0, "2", "2", "n", "w", 11.0, "a", "b",
        "ag",
    )


def test_strict_text_fails_and_lenient_counts_as_nothing(spark):
    headers = list(monthly.TOUTIAO.values())
    raw = table(spark, headers, [["2", "n", "co", None, "1,234", "3", "a", "b", "11", "ag"]])
    with pytest.raises(Exception, match="not a number"):
        monthly.toutiao(raw, None).collect()
    assert monthly.toutiao(raw, None, lenient=True).first()["结算消耗"] == -3.0


def media_parts(spark):
    return {
        "小红书": table(spark, ["发生金额(元)", "子账户名称", "资金类型"], [["5", "1", "现金"], [None, "1", "赠款"]]),
        "汇川": table(spark, ["客户名称", "花费", "账户ID", "账户名称", "新客"], [["a", "7", "1", "n", "是"], ["b", "1", "1", "n", None], ["a", None, "1", "m", None]]),
        "趣头条": table(spark, ["广告主名称", "总消费", "赔付充值", "广告主id", "广告主账号"], [["q", "x", "1", "2", "l"], ["q", "10", "", "2", "l"], ["q", None, None, "2", "l"]]),
        "其他综媒": table(spark, ["广告主名称", "总消费", "赔付充值", "广告主id", "广告主账号"], [["q", "3", "1", "2", "k"]]),
    }


def test_media_merge(spark, account):
    parts = {m: media.medium_part(raw, m) for m, raw in media_parts(spark).items()}
    out = media.media_merge(parts, account)
    assert tuple(out.columns) == (*media.OUT, "数据源")
    got = [(r["客户名称"], r["客户名称_原始"], r["消费"], r["账户id"], r["账户名称"], r["平台新客"], r["数据源"]) for r in out.collect()]
    assert got == [
        ("c2", "q", 11.0, "2", "k", None, "其他综媒"),
        ("c1", "a", 7.0, "1", "m", "是", "汇川"),
        ("c1", "小红书", 5.0, "1", "1", "现金", "小红书"),
        ("c1", "b", 1.0, "1", "n", None, "汇川"),
    ]


def test_media_single_source_has_no_source_column(spark):
    parts = {"小红书": media.medium_part(media_parts(spark)["小红书"], "小红书")}
    out = media.media_merge(parts, None)
    assert tuple(out.columns) == media.OUT and out.first()["AE"] is None
    with pytest.raises(ValueError):
        media.media_merge({}, None)
    with pytest.raises(ValueError):
        media.media_merge({"x": parts["小红书"]}, None)


def test_third_spelling_and_fallback_of_qutoutiao(spark):
    raw = table(spark, ["客户名称", "成本", "账号ID", "账号名称", "平台新客"], [["c", "2", "1", "n", None]])
    assert media.medium_part(raw, "趣头条").first()["消费"] == 2.0

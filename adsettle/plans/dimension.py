"""The account dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame

from adsettle.operators.projection import bind, fields
from adsettle.operators.totals import first_per_key

# Headers of the account list. The weekly queries use the first four.
WEEK_ACCOUNT = {
    "id": "账号ID",
    "n1": "媒体账户主体",
    "n2": "客户名称",
    "n3": "客户编号",
}
MONTH_ACCOUNT = {
    **WEEK_ACCOUNT,
    "n4": "AE",
    "n5": "销售",
    "n6": "返点比率",
    "n7": "返点形式",
    "n8": "端口",
}

# A file whose name holds one of these is the account list.
ACCOUNT_FILE_WORDS = ("媒体账户", "媒体账号", "账户列表", "账号列表")


def account_dimension(raw: DataFrame, headers: dict[str, str] = MONTH_ACCOUNT) -> DataFrame:
    """One row per account id, each attribute a non-NULL value where any copy has one."""
    return first_per_key(bind(raw, fields(headers)), ["id"])

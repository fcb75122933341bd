"""Scalar decodes of the four change logs, as built-in column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The placeholder for missing text.
BLANK = " "

# Code lists, code 1 is the first entry.
SKIN_TYPES = ("", "中性", "干性", "混合性", "油性")
ALLERGIES = ("", "从不", "偶尔", "易过敏")
SKIN_COLORS = ("", "白皙", "粉嫩", "暗黄", "大麦色")
IMPROVEMENTS = (
    "",
    "敏感/脆弱",
    "黑头粉刺/毛孔粗大/皮肤粗糙",
    "痘痘",
    "细纹/皮肤松弛",
    "暗黄/色斑",
    "黑眼圈/轻度眼袋/脂肪粒",
    "严重眼袋/眼纹",
)

# Order status texts.
SUBMITTED = "已提交"
SHIPPED = "已发货"
SIGNED = "已签收"


def gender(code: Column) -> Column:
    return F.when(code == 2, F.lit(2)).when(code == 3, F.lit(1)).otherwise(F.lit(0))


def solar_birthday(calendar: Column, birthday: Column) -> Column:
    return F.when(birthday.isNull(), F.lit("")).when(calendar.isin(0, 2, 3), birthday).otherwise(F.lit(BLANK))


def lunar_birthday(calendar: Column, birthday: Column) -> Column:
    return (
        F.when(birthday.isNull() | calendar.isin(0, 2, 3), F.lit(BLANK))
        .when(calendar.isin(1, 4), birthday)
        .otherwise(F.lit(""))
    )


def blank_fill(text: Column) -> Column:
    return F.coalesce(text, F.lit(BLANK))


def yes_no(flag: Column) -> Column:
    return F.when(flag == 0, F.lit("n")).when(flag == 1, F.lit("y"))


def label(code: Column, labels: Sequence[str]) -> Column:
    """Text of a 1-based code; null when the code is outside the list."""
    entries = F.array(*[F.lit(text) for text in labels])
    return F.when(code.between(1, len(labels)), F.get(entries, code - 1))


def order_status(sign_time: Column, ship_time: Column, submit_time: Column) -> Column:
    """First rule that holds wins; an unsigned order has the blank placeholder by contract."""
    return (
        F.when(sign_time == 0, F.lit(BLANK))
        .when(ship_time == 0, F.lit(SUBMITTED))
        .when(submit_time == 0, F.lit(SHIPPED))
        .otherwise(F.lit(SIGNED))
    )

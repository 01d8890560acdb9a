"""Scalar building blocks. Each takes and returns columns, so every plan made of
them stays inside the JVM and its generated code."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from retail_lake.schemas import MONEY, PRICE, RATE

WHITESPACE = " \t\r\n\f\v"


def tidy(text: Column) -> Column:
    """Strip every kind of surrounding whitespace (plain ``trim`` strips spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def email(text: Column) -> Column:
    return F.lower(tidy(text))


def country(text: Column) -> Column:
    """Capitalised country; both the empty string and NULL become ``Unknown``.

    A CSV reader turns an empty field into NULL, so testing for ``''`` alone
    would never fire on files.
    """
    return F.coalesce(F.nullif(F.initcap(tidy(text)), F.lit("")), F.lit("Unknown"))


def price(value: Column) -> Column:
    """Price of one unit with its digits, NULL when it does not parse."""
    return value.try_cast(PRICE)


def rate(value: Column) -> Column:
    return value.try_cast(RATE)


def whole(value: Column) -> Column:
    """Integer part of a number or numeric text (``'2'``, ``'2.0'``), else NULL."""
    return value.try_cast("decimal(20,4)").try_cast("int")


def calendar_date(value: Column) -> Column:
    return value.try_cast("date")


def instant(value: Column) -> Column:
    return value.try_cast("timestamp")


def gross(quantity: Column, unit_price: Column) -> Column:
    """Amount of a line, rounded half up to cents; NULL when it overflows."""
    return F.round(quantity * unit_price, 2).try_cast(MONEY)


def net(gross_amount: Column, discount: Column) -> Column:
    """Discounted amount, rounded half up to cents; an unknown discount gives NULL."""
    return F.round(gross_amount * (F.lit(1).cast(RATE) - discount), 2).try_cast(MONEY)


def date_key(day: Column) -> Column:
    """``yyyyMMdd`` as an int, from integer arithmetic instead of formatted text."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_key(day: Column) -> Column:
    """``yyyyMM`` as an int."""
    return F.year(day) * 100 + F.month(day)


def calendar(day: Column) -> dict[str, Column]:
    """Attributes of a calendar day."""
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day_of_week": F.date_format(day, "EEEE"),
        "is_weekend": F.dayofweek(day).isin(1, 7),  # 1 is Sunday, 7 is Saturday
    }

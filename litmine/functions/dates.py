"""Partial dates: day, month or year precision, kept as found."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from litmine.functions.text import let, text_or_empty

# English month names, short and full, case-sensitive.
MONTH_NAMES = (
    ("Jan", "January"), ("Feb", "February"), ("Mar", "March"), ("Apr", "April"),
    ("May", "May"), ("Jun", "June"), ("Jul", "July"), ("Aug", "August"),
    ("Sep", "September"), ("Oct", "October"), ("Nov", "November"), ("Dec", "December"),
)
# The first word of exactly four digits, and the two messages.
YEAR_IN_FREE_TEXT = r"\A.*?\b(\d{4})\b.*\z"
NO_MONTH = "Could not extract month from node"
NO_DATE = "Could not parse XML node as date"

XSD = "http://www.w3.org/2001/XMLSchema#"
PARTIAL_DATE = "struct<precision:string,year:int,month:int,day:int,error:string>"


def _strict_int(value: Column) -> Column:
    """An optional sign and digits only; Spark's cast would also accept padding."""
    return F.when(value.rlike(r"\A[+-]?\d+\z"), value.try_cast("int"))


def _month_number(month: Column, year: Column) -> Column:
    numbers = {name: n for n, names in enumerate(MONTH_NAMES, start=1) for name in names}
    by_name = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    # A month name is only read next to a four-digit year.
    named = F.when(year.between(1000, 9999), F.try_element_at(by_name, month))
    return F.coalesce(_strict_int(month), named)


def _days_in_month(year: Column, month: Column) -> Column:
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    return (
        F.when(month == 2, F.when(leap, 29).otherwise(28))
        .when(month.isin(4, 6, 9, 11), 30)
        .otherwise(31)
    )


def parse_partial_date(year: Column, month: Column, day: Column, medline_date: Column) -> Column:
    """``struct<precision, year, month, day, error>`` from the four text fields.

    An impossible day falls back to the month, an impossible month number to
    the year; a day with an unreadable month is an error; without a year the
    first four-digit word of the free-text date is used.
    """
    no_int = F.lit(None).cast("int")
    no_text = F.lit(None).cast("string")

    def build(precision: str | None, yy=no_int, mm=no_int, dd=no_int, error: str | None = None) -> Column:
        return F.struct(
            (F.lit(precision) if precision else no_text).alias("precision"),
            yy.alias("year"), mm.alias("month"), dd.alias("day"),
            (F.lit(error) if error else no_text).alias("error"),
        )

    def decide(f: Column) -> Column:
        y, m, d, free_year = f["y"], f["m"], f["d"], f["free_year"]
        month_ok = m.between(1, 12)
        day_ok = d.between(1, _days_in_month(y, m))
        return (
            F.when(y.isNull() & free_year.isNotNull(), build("year", free_year))
            .when(y.isNull(), build(None, error=NO_DATE))
            .when(month_ok & day_ok, build("day", y, m, d))
            .when(month_ok, build("month", y, m))
            .when(m.isNull() & d.isNotNull(), build(None, error=NO_MONTH))
            .otherwise(build("year", y))
        )

    def numbers(f: Column) -> Column:
        y = F.when(f["y"].between(-999999999, 999999999), f["y"])
        free_year = F.when(y.isNull(), F.regexp_extract(text_or_empty(medline_date), YEAR_IN_FREE_TEXT, 1))
        return F.struct(
            y.alias("y"), _month_number(f["month"], f["y"]).alias("m"), f["d"].alias("d"),
            F.when(free_year != "", free_year).cast("int").alias("free_year"),
        )

    fields = F.struct(
        _strict_int(text_or_empty(year)).alias("y"), text_or_empty(month).alias("month"),
        _strict_int(text_or_empty(day)).alias("d"),
    )
    return let(let(fields, numbers), decide)


def date_lexical(date: Column) -> Column:
    """``yyyy-MM-dd``, ``yyyy-MM`` or the bare year; NULL for an error entry."""
    return (
        F.when(date.precision == "day", F.format_string("%04d-%02d-%02d", date.year, date.month, date.day))
        .when(date.precision == "month", F.format_string("%04d-%02d", date.year, date.month))
        .when(date.precision == "year", date.year.cast("string"))
    )


def date_xsd_type(date: Column) -> Column:
    """The XML Schema type that matches the precision."""
    return (
        F.when(date.precision == "day", F.lit(XSD + "date"))
        .when(date.precision == "month", F.lit(XSD + "gYearMonth"))
        .when(date.precision == "year", F.lit(XSD + "gYear"))
    )

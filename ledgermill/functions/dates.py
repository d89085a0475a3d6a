"""Date parsing and calendar attributes as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fixed_values import MONTH_NAMES, WEEKDAY_NAMES
from .text import empty_to_null, lookup, stepwise, strip_blanks, strip_column

_ISO_SHAPE = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}\z"


def _parted(text: Column, sign: str, first: int, second: int, length: int = 10) -> Column:
    """Does a text of so many characters have `sign` at both places, and not before? Tells the usual layouts without a
    regular expression, and without copies of the characters."""
    return (F.length(text) == length) & (F.instr(text, sign) == first) & (F.locate(sign, text, first + 1) == second)


# The usual layouts are put in order as they are: what is no digit fits no date afterwards.
def _day_first_to_iso(text: Column) -> Column:
    usual = F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2))
    return F.when(_parted(text, "/", 3, 6), usual).otherwise(F.regexp_replace(text, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$2-$1"))


def _month_first_to_iso(text: Column) -> Column:
    usual = F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 1, 5))
    return F.when(_parted(text, "-", 3, 6), usual).otherwise(F.regexp_replace(text, r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "$3-$1-$2"))


def _is_iso(text: Column) -> Column:
    """May the text be cast? Casting alone would also read a time after the day, and the year 0."""
    usual = _parted(text, "-", 5, 8) & F.lit("0123456789").contains(F.substring(text, 10, 1)) & ~text.startswith("0000")
    return usual | text.rlike(_ISO_SHAPE)


# For each further layout: a cheap test that sends a text to its rewriting as year-month-day, and the rewriting.
_REWRITES = {
    "d/m/y": (lambda text: text.contains("/"), _day_first_to_iso),
    "m-d-y": (lambda text: F.substring(text, -5, 1) == "-", _month_first_to_iso),
}

CLIENT_LAYOUTS = ("d/m/y",)
LEDGER_LAYOUTS = ("d/m/y", "m-d-y")


def parse_dates(df: DataFrame, column: str, layouts: tuple[str, ...], repair_feb29: bool = False) -> DataFrame:
    """Parse year-month-day text, and the other `layouts`, into a date; anything else becomes null.

    With `repair_feb29`, 29 February of a year that has none becomes the 28th (two-digit day and month only).
    Columns that are dates or timestamps already are only cast.
    """
    if isinstance(df.schema[column].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return df.withColumn(column, F.col(column).cast("date"))

    # The shapes exclude each other, so rewriting first and parsing once equals trying one format after the other.
    # Missing-value words fit none of them. A text whose first hyphen is its fifth character fits no layout but the first.
    def to_iso(text: Column) -> Column:
        iso = text
        for layout in reversed(layouts):
            looks_like, rewrite = _REWRITES[layout]
            iso = F.when(looks_like(text), rewrite(text)).otherwise(iso)
        return F.when(F.instr(text, "-") == 5, text).otherwise(iso)

    def to_date(iso: Column) -> Column:
        return F.when(_is_iso(iso), iso.try_cast("date"))

    df = stepwise(df, column, [strip_column, to_iso])
    if not repair_feb29:
        return stepwise(df, column, [to_date])
    # The methods made of these steps must stay short enough for the JVM to compile, and a cast that fails is slow: 29
    # February is the last day of the month of the 1st, whether or not the year has it.
    leap = "__feb29"
    df = df.withColumn(leap, F.col(column).endswith("-02-29"))
    steps = [lambda iso: F.when(F.col(leap), F.concat(F.left(iso, F.lit(8)), F.lit("01"))).otherwise(iso), to_date,
             lambda day: F.when(F.col(leap), F.last_day(day)).otherwise(day)]
    return stepwise(df, column, steps).drop(leap)


def month_key(day: Column) -> Column:
    return F.trunc(day, "MM")


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def month_name(month: Column) -> Column:
    return lookup(month.cast("int"), {i + 1: name for i, name in enumerate(MONTH_NAMES)})


def weekday_name(weekday: Column) -> Column:
    return lookup(weekday.cast("int"), dict(enumerate(WEEKDAY_NAMES)))


def first_of_month(year: Column, month: Column) -> Column:
    return F.when(month.between(1, 12) & year.between(1, 9999), F.make_date(year, month, F.lit(1)))


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Attributes of a calendar day, in output order."""
    weekday = F.weekday(day)
    return {
        "ano": F.year(day).cast("bigint"),
        "trimestre": F.quarter(day).cast("bigint"),
        "mes": F.month(day).cast("bigint"),
        "nome_mes": month_name(F.month(day)),
        "dia": F.day(day).cast("bigint"),
        "dia_semana_num": weekday.cast("bigint"),
        "nome_dia_semana": weekday_name(weekday),
        "fim_de_semana": weekday >= 5,
    }


def plain_label(label: Column) -> Column:
    """Month label in lower case without accents and dots; null counts as empty."""
    text = F.lower(strip_blanks(F.coalesce(label, F.lit(""))))
    return F.translate(text, "çáàâãéêíóôõú.", "caaaaeeiooou")


def label_month(plain: Column) -> Column:
    """Month number of a plain label such as `01/2025`, `marco de 2025` or `ago/2025`."""
    numbers = {}
    for i, name in enumerate(MONTH_NAMES):
        numbers[name] = numbers[name[:3]] = i + 1
    word = empty_to_null(F.regexp_extract(plain, "([a-z]+)", 1))
    return F.when(plain.rlike(r"^\d{2}/\d{4}$"), F.left(plain, F.lit(2)).try_cast("int")).otherwise(lookup(word, numbers))


def label_year(plain: Column) -> Column:
    return F.regexp_extract(plain, r"(\d{4})", 1).try_cast("int")

"""Numbers, amounts and currency conversion as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fixed_values import ARS_SELL_RATE, HOME_CURRENCY
from .text import stepwise, strip_blanks, strip_column

# Plain and scientific notation. Casting alone would also read `12d` and `nan` as numbers.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def text_to_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def text_to_bigint(text: Column) -> Column:
    """Whole numbers, also when written `12.0`; anything else is null.

    A text with a dot is none that can be cast, and a cast that fails costs many times one that does not.
    """
    number = text_to_double(text)
    whole = F.when(~text.contains("."), text.try_cast("bigint"))
    return F.coalesce(whole, F.when(number == F.floor(number), number.try_cast("bigint")))


def to_number(df: DataFrame, column: str) -> DataFrame:
    if isinstance(df.schema[column].dataType, T.NumericType):
        value = F.col(column).cast("double")
        return df.withColumn(column, F.when(~F.isnan(value), value))
    return stepwise(df, column, [strip_column, text_to_double])


def to_identifier(df: DataFrame, column: str) -> DataFrame:
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return df.withColumn(column, F.col(column).cast("bigint"))
    if isinstance(kind, T.NumericType):
        value = F.col(column).cast("double")
        return df.withColumn(column, F.when(value == F.floor(value), value.try_cast("bigint")))
    return stepwise(df, column, [strip_column, text_to_bigint])


def to_target_amount(df: DataFrame, column: str, target: str) -> DataFrame:
    """Amount text with dots for thousands, a decimal comma and an optional `k` for thousands."""
    if isinstance(df.schema[column].dataType, T.NumericType):
        return df.withColumn(target, F.col(column).cast("double"))

    def plain(text: Column) -> Column:
        return F.translate(F.lower(strip_blanks(text)), ",.", ".")

    def value(text: Column) -> Column:
        in_thousands = F.btrim(F.regexp_replace(text, "k$", ""))
        return F.when(text.endswith("k"), text_to_double(in_thousands) * 1000).otherwise(text_to_double(text))

    return stepwise(df, target, [plain, value], source=column)


def brl_value(amount: Column, currency: Column, paid_on: Column, sell_rate: Column,
              ars_rate: float = ARS_SELL_RATE, plain: bool = False) -> Column:
    """Amount in home currency: at the sell rate of the payment day, unchanged where no rate applies.

    `plain` tells that the codes are in upper case and without blanks already.
    """
    code = F.coalesce(currency, F.lit(""))
    code = code if plain else F.upper(strip_blanks(code))
    unchanged = code.isin("", HOME_CURRENCY) | paid_on.isNull()
    return (
        F.when(unchanged, amount)
        .when(code == "ARS", amount * F.lit(ars_rate))
        .otherwise(amount * F.coalesce(sell_rate, F.lit(1.0)))
    )


def exact(amount: Column) -> Column:
    """Amount as a decimal number, whose sums do not depend on the order in which partitions arrive."""
    return amount.try_cast("decimal(38,10)")


def stable_sum(amount: Column) -> Column:
    """Sum of exact amounts, rounded to a millionth. Null if the amounts pass what 28 digits before the point hold."""
    return F.round(F.try_sum(amount), 6).cast("double")

"""Daily exchange rates: which days are needed, the latest quote of each, and gaps filled."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import LEDGER_LAYOUTS, month_key, parse_dates
from ..functions.fixed_values import COUNTRY_CURRENCY, HOME_CURRENCY
from ..functions.text import held
from ..operators.calendar import daily_range, days_of_months, fill_forward
from ..operators.dedup import ORDINAL, arrival, keep_first, last_arrived
from ..sources.shared import materialise


def payment_months(receivables: DataFrame, repair_feb29: bool = False) -> DataFrame:
    """First days of the months in which receivables were paid."""
    # The texts are made distinct first, so a calendar's worth of them is parsed.
    paid = parse_dates(receivables.select("data_pagamento").distinct(), "data_pagamento", LEDGER_LAYOUTS, repair_feb29)
    days = paid.select(month_key(F.col("data_pagamento")).alias("mes")).distinct()
    return held(days, ["mes"]).where("mes is not null")


def quote_days(months: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Days to quote: those of the payment months within the bounds, or the bounds themselves if no month is known."""
    if start is None or end is None:
        return days_of_months(months, "mes", start, end)
    # Read twice below. There are at most as many rows as a calendar has months.
    months = materialise(months)
    days = days_of_months(months, "mes", start, end)
    no_months = months.agg(F.count(F.lit(1))).scalar() == 0
    return days.unionAll(daily_range(months.sparkSession, start, end).where(no_months))


def currencies_of_countries(countries: DataFrame, column: str) -> DataFrame:
    """Foreign currencies of the requested countries."""
    foreign = {c: m for c, m in COUNTRY_CURRENCY.items() if m != HOME_CURRENCY}
    named = F.try_element_at(F.create_map(*[F.lit(x) for item in foreign.items() for x in item]), F.col(column))
    return countries.select(named.alias("moeda")).where("moeda is not null").distinct()


def latest_quotes(quotes: DataFrame) -> DataFrame:
    """The last quote of each currency and day; the first to arrive wins between equal timestamps."""
    stamped = quotes.where(F.coalesce("data_hora_cotacao", F.lit("")) != "")
    daily = stamped.withColumn("data", F.left("data_hora_cotacao", F.lit(10)).try_cast("date"))
    last = keep_first(daily, ["moeda", "data"], [F.col("data_hora_cotacao").desc(), *arrival(daily)])
    return last.select("moeda", "data", "cotacao_compra", "cotacao_venda")


def complete_quotes(quotes: DataFrame, days: DataFrame, currencies: list[str]) -> DataFrame:
    """A quote for every requested day and currency, carried over from the last day that has one.

    Of several quotes for a day the last to arrive counts. Days before a currency's first quote have none. The grid is the calendar times the fixed list of currencies, so it stays small whatever the number of quotes.
    """
    grid = days.select(F.explode(F.lit(sorted(currencies))).alias("moeda"), "data")
    known = last_arrived(quotes.where("data is not null"), ["moeda", "data"]).drop(ORDINAL)
    filled = fill_forward(
        grid.join(known, ["moeda", "data"], "left"),
        "moeda", "data", ["cotacao_compra", "cotacao_venda"],
    )
    return filled.where("cotacao_compra is not null and cotacao_venda is not null")


def quote_counts(quotes: DataFrame, completed: DataFrame) -> DataFrame:
    """Rows before and after filling."""
    before = quotes.agg(F.count(F.lit(1)).alias("linhas_originais"))
    return completed.agg(F.count(F.lit(1)).alias("linhas_completas")).select(
        before.scalar().alias("linhas_originais"), "linhas_completas"
    )

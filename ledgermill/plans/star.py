"""Star schema: four dimensions, three facts, and roll-ups over them."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import calendar_attributes
from ..functions.fixed_values import HOME_CURRENCY
from ..functions.money import exact, stable_sum, to_identifier
from ..functions.text import empty_to_null, join_key
from ..operators.dedup import ORDINAL, first_arrived, last_arrived
from ..operators.headers import tidy_headers
from ..operators.lookups import lookup_join
from ..operators.ordering import continued_key
from ..schemas import GOLD
from ..sources.shared import materialise, side_by_side


@dataclass
class Star:
    dim_cliente: DataFrame
    dim_categoria: DataFrame
    dim_data: DataFrame
    dim_moeda: DataFrame
    fato_conta_receber: DataFrame
    fato_conta_pagar: DataFrame
    fato_meta_mensal: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def _project(df: DataFrame, table: str) -> DataFrame:
    return df.select(*GOLD[table].fieldNames())


def dim_client(clients: DataFrame) -> DataFrame:
    df = to_identifier(tidy_headers(clients), "id_cliente").where("id_cliente is not null")
    return _project(first_arrived(df, ["id_cliente"]), "dim_cliente")


def dim_category(categories: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    df = tidy_headers(categories)
    df = df.withColumn("codigo_categoria", empty_to_null(join_key(F.col("codigo_categoria"))))
    df = first_arrived(df.where("codigo_categoria is not null"), ["codigo_categoria"])
    keyed = continued_key(df, "sk_categoria", ["codigo_categoria"], ["codigo_categoria"], existing)
    return _project(keyed, "dim_categoria")


def _small_key(df: DataFrame, name: str, key: str, existing: DataFrame | None) -> DataFrame:
    """Number a dimension whose size is bounded by rule in the order of its key, after the numbers it already has."""
    number = F.row_number().over(Window.orderBy(key)).cast("bigint")
    if existing is None:
        return df.withColumn(name, number)
    held = existing.select(key, name)
    highest = F.coalesce(existing.agg(F.max(name)).scalar(), F.lit(0))
    new = df.join(held.select(key), key, "left_anti").withColumn(name, number + highest)
    return df.join(held, key).unionByName(new)


def dim_currency(clients: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Currencies of the clients and the home currency. There are only as many as the world has currencies."""
    code = F.upper(join_key(F.col("moeda_pais"))).alias("codigo_moeda")
    home = clients.sparkSession.range(1).select(F.lit(HOME_CURRENCY).alias("codigo_moeda"))
    codes = tidy_headers(clients).select(code).where("codigo_moeda is not null").distinct().unionAll(home).distinct()
    return _project(_small_key(codes, "sk_moeda", "codigo_moeda", existing), "dim_moeda")


def dim_date(targets: DataFrame, payables: DataFrame, receivables: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Every day any table mentions.

    Days are made distinct inside each partition before the shuffle, and a calendar of four-digit years has fewer
    than four million of them, so numbering them in one task is safe.
    """
    due_and_paid = ["data_vencimento", "data_pagamento"]
    mentioned = [(targets, ["mes_ano_meta"]), (payables, due_and_paid), (receivables, due_and_paid)]
    days = None
    for table, columns in mentioned:
        day = F.explode(F.array(*[F.col(c).cast("date") for c in columns])).alias("data_calendario")
        part = tidy_headers(table).select(day).distinct()
        days = part if days is None else days.unionAll(part)
    days = days.where("data_calendario is not null").distinct()
    numbered = _small_key(days, "sk_data", "data_calendario", existing)
    return _project(numbered.withColumns(calendar_attributes(F.col("data_calendario"))), "dim_data")


def _date_key(facts: DataFrame, dates: DataFrame, column: str, key: str) -> DataFrame:
    role = dates.select(F.col("data_calendario").alias(column), F.col("sk_data").alias(key))
    return lookup_join(facts, role, [column])


def _ledger_keys(ledger: DataFrame, categories: DataFrame, dates: DataFrame) -> DataFrame:
    """Last arrival of each entry, with its category and date keys."""
    df = to_identifier(tidy_headers(ledger), "id_conta").where("id_conta is not null")
    df = last_arrived(df, ["id_conta"]).withColumn("codigo_categoria", join_key(F.col("codigo_categoria")))
    df = lookup_join(df, categories.select("codigo_categoria", "sk_categoria"), ["codigo_categoria"])
    df = _date_key(df, dates, "data_pagamento", "sk_data_pagamento")
    return _date_key(df, dates, "data_vencimento", "sk_data_vencimento")


def _home_key(currencies: DataFrame):
    return currencies.where(F.col("codigo_moeda") == HOME_CURRENCY).select("sk_moeda").scalar()


def fact_receivable(receivables: DataFrame, clients: DataFrame, categories: DataFrame, currencies: DataFrame,
                    dates: DataFrame) -> DataFrame:
    """Receivables keyed to the dimensions; entries of unknown clients count as home currency."""
    df = _ledger_keys(to_identifier(tidy_headers(receivables), "id_cliente"), categories, dates)
    # The currency key is put on the clients first, and only foreign ones are looked up.
    foreign = clients.withColumn("codigo_moeda", F.upper("moeda_pais")).where(F.col("codigo_moeda") != HOME_CURRENCY)
    keyed = lookup_join(foreign.select("id_cliente", "codigo_moeda"), currencies, ["codigo_moeda"])
    df = lookup_join(df, keyed.select("id_cliente", "sk_moeda"), ["id_cliente"])
    df = df.withColumn("sk_moeda", F.coalesce("sk_moeda", _home_key(currencies)))
    return _project(df.withColumnRenamed("id_conta", "id_conta_receber"), "fato_conta_receber")


def fact_payable(payables: DataFrame, categories: DataFrame, currencies: DataFrame, dates: DataFrame) -> DataFrame:
    """Payables keyed to the dimensions, always in home currency."""
    df = _ledger_keys(payables, categories, dates).withColumn("sk_moeda", _home_key(currencies))
    return _project(df.withColumnRenamed("id_conta", "id_conta_pagar"), "fato_conta_pagar")


def fact_target(targets: DataFrame, dates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Monthly targets, numbered in order of arrival; a month that already has a number keeps it."""
    df = tidy_headers(targets)
    order = [ORDINAL] if ORDINAL in df.columns else df.columns
    numbered = continued_key(df, "sk_fato_meta", order, ["ano", "mes"], existing)
    return _project(_date_key(numbered, dates, "mes_ano_meta", "sk_data_referencia"), "fato_meta_mensal")


def build_star(clients: DataFrame, categories: DataFrame, targets: DataFrame, payables: DataFrame,
               receivables: DataFrame, existing: Star | None = None) -> Star:
    """All seven tables. Dimensions are written once, since every fact reads them; facts stay lazy.

    With the star of an earlier load, keys go on from it: rows are recognised by their natural key, so appending what
    is new leaves keys unique and old facts right.
    """
    def held(name: str) -> DataFrame | None:
        return existing and getattr(existing, name)

    client, category, currency, day = side_by_side(
        lambda: materialise(dim_client(clients)),
        lambda: materialise(dim_category(categories, held("dim_categoria"))),
        lambda: materialise(dim_currency(clients, held("dim_moeda"))),
        lambda: materialise(dim_date(targets, payables, receivables, held("dim_data"))),
    )
    return Star(
        dim_cliente=client, dim_categoria=category, dim_data=day, dim_moeda=currency,
        fato_conta_receber=fact_receivable(receivables, client, category, currency, day),
        fato_conta_pagar=fact_payable(payables, category, currency, day),
        fato_meta_mensal=fact_target(targets, day, held("fato_meta_mensal")),
    )


def roll_up(facts: DataFrame, dimensions: list[tuple[DataFrame, str, str]], by: list[str], measure: str) -> DataFrame:
    """Sum and count of a measure by attributes of the dimensions, given as (table, key in the facts, its key).

    Facts are summed by the keys first, so only key combinations are joined and shuffled, not facts.
    """
    keys = [fact_key for _, fact_key, _ in dimensions]
    rows = facts.groupBy(*keys).agg(F.try_sum(exact(F.col(measure))).alias("__sum"), F.count(F.lit(1)).alias("__rows"))
    for table, fact_key, key in dimensions:
        attributes = [c for c in table.columns if c in by]
        rows = lookup_join(rows, table.select(F.col(key).alias(fact_key), *[c for c in attributes if c != fact_key]),
                           [fact_key])
    return rows.groupBy(*by).agg(stable_sum(F.col("__sum")).alias(f"{measure}_total"), F.sum("__rows").alias("lancamentos"))

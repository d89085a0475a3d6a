"""Cleaning of the five source tables.

Where a source carries the ingest ordinal, the cleaned table carries it on, because gold needs it to pick the last
arrival of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import (
    CLIENT_LAYOUTS, LEDGER_LAYOUTS, first_of_month, label_month, label_year, month_name, parse_dates, plain_label,
)
from ..functions.fixed_values import ARS_SELL_RATE, HOME_CURRENCY
from ..functions.money import brl_value, to_identifier, to_number, to_target_amount
from ..functions.text import CATEGORY_LABEL, COUNTRY_NAME, KEY_TEXT, PERSON_NAME, currency_of, held, stepwise, strip_blanks
from ..operators.dedup import ORDINAL, best_labelled, first_arrived
from ..operators.headers import require_columns, tidy_headers, with_optional
from ..operators.lookups import lookup_join
from ..schemas import RAW, SILVER


def _project(df: DataFrame, table: str) -> DataFrame:
    ordinal = [ORDINAL] if ORDINAL in df.columns else []
    return df.select(*SILVER[table].fieldNames(), *ordinal)


def clean_targets(raw: DataFrame) -> DataFrame:
    df = require_columns(tidy_headers(raw), RAW["PS_Meta2025"])
    df = df.withColumn("__label", plain_label(F.col("mes_meta")))
    df = df.withColumns({"mes": label_month(F.col("__label")), "ano": label_year(F.col("__label"))})
    df = to_target_amount(df, "meta", "meta_valor")
    return _project(df.withColumns({
        "mes_ano_meta": first_of_month(F.col("ano"), F.col("mes")),
        "nome_mes": month_name(F.col("mes")),
        "mes": F.col("mes").cast("bigint"),
        "ano": F.col("ano").cast("bigint"),
    }), "meta_2025_silver")


def clean_categories(raw: DataFrame) -> DataFrame:
    df = require_columns(tidy_headers(raw), RAW["PS_Categoria"])
    df = stepwise(df, "codigo_categoria", KEY_TEXT).where(F.col("codigo_categoria").isNotNull())
    # Labels are compared after cleaning: one of blanks or punctuation only counts as missing.
    df = stepwise(df, "nome_categoria", CATEGORY_LABEL)
    df = stepwise(df, "tipo_categoria", CATEGORY_LABEL)
    best = best_labelled(df, "codigo_categoria", ["nome_categoria", "tipo_categoria"])
    return best.select(*SILVER["categoria_silver"].fieldNames())


def clean_clients(raw: DataFrame) -> DataFrame:
    df = require_columns(tidy_headers(raw), RAW["PS_Cliente"])
    df = held(to_identifier(df, "id_cliente"), ["id_cliente"]).where(F.col("id_cliente").isNotNull())
    df = stepwise(df, "nome_cliente", PERSON_NAME)
    df = stepwise(df, "pais_cliente", COUNTRY_NAME)
    df = parse_dates(df, "data_cadastro_cliente", CLIENT_LAYOUTS)
    return _project(df.withColumn("moeda_pais", currency_of(F.col("pais_cliente"))), "cliente_silver")


def _clean_ledger(df: DataFrame, keys: list[str]) -> DataFrame:
    needed = [*keys, "valor_conta"]
    for key in keys:
        df = to_identifier(df, key)
    df = held(to_number(df, "valor_conta"), needed).dropna(subset=needed)
    for column in ("data_vencimento", "data_pagamento"):
        df = parse_dates(df, column, LEDGER_LAYOUTS, repair_feb29=True)
    return with_optional(df, "observacao_conta")


def clean_payables(raw: DataFrame) -> DataFrame:
    df = _clean_ledger(require_columns(tidy_headers(raw), RAW["PS_Conta_Pagar"]), ["id_conta"])
    return _project(df.withColumn("valor_conta_brl", F.col("valor_conta")), "conta_pagar_silver")


def clean_receivables(raw: DataFrame, clients: DataFrame | None = None, rates: DataFrame | None = None,
                      ars_rate: float = ARS_SELL_RATE) -> DataFrame:
    """Receivables with their value in home currency.

    `clients` and `rates` are the cleaned clients and the completed daily rates. Without them amounts stay as they are.
    """
    df = require_columns(tidy_headers(raw), RAW["PS_Conta_Receber"])
    df = _clean_ledger(with_optional(df, "status_conta", "status"), ["id_conta", "id_cliente"])

    if clients is None:
        df = df.withColumn("moeda_pais", F.lit(None).cast("string"))
    else:
        # Only clients with a foreign currency change an amount.
        code = F.upper(strip_blanks(F.col("moeda_pais"))).alias("moeda_pais")
        currency = first_arrived(clients, ["id_cliente"]).select("id_cliente", code)
        df = lookup_join(df, currency.where(F.col("moeda_pais") != HOME_CURRENCY), ["id_cliente"])

    if rates is None:
        df = df.withColumn("cotacao_venda", F.lit(None).cast("double"))
    else:
        sell = first_arrived(rates.select("moeda", "data", "cotacao_venda"), ["moeda", "data"])
        sell = sell.toDF("moeda_pais", "data_pagamento", "cotacao_venda")
        df = lookup_join(df, sell, ["moeda_pais", "data_pagamento"])

    value = brl_value(F.col("valor_conta"), F.col("moeda_pais"), F.col("data_pagamento"), F.col("cotacao_venda"),
                      ars_rate, plain=True)
    return _project(df.withColumn("valor_conta_brl", value), "conta_receber_silver")

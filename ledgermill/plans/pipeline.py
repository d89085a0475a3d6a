"""The layers from raw files to segments. Each step reads what the step before wrote."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from datetime import date
from functools import partial, reduce, wraps
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_key
from ..functions.fixed_values import COUNTRY_CURRENCY, HOME_CURRENCY
from ..operators import checks
from ..operators.lookups import lookup_join
from ..schemas import GOLD, RATES, SILVER
from ..sources.layers import feed_names, read_csv, read_json, read_layer, read_layer_parts, remove_layer, write_layer
from ..sources.rate_payloads import read_rate_payloads
from ..sources.shared import removing_tables, side_by_side
from . import customers, rates, segments, silver
from .star import Star, build_star


# Table of the silver layer that tells rows before and after, and rows with something missing, paid or open.
QUALITY = "qualidade_silver"
# Bytes of a bronze ledger that are cleaned and shuffled by month at the same time; the shuffle takes some three times as much disk.
LEDGER_PART = 256 << 20


def land(tables: dict[str, Callable[[], DataFrame]], bronze: str, output_format: str = "parquet") -> dict[str, str]:
    """Store raw tables unchanged with their arrival order. A table that fails does not stop the others. They are stored one
    after the other, so the disk never holds the shuffles of two.

    Returns the error text of the tables that failed.
    """
    spark = SparkSession.active()

    def store(name: str, read: Callable[[], DataFrame]) -> str | None:
        try:
            with removing_tables(spark):
                write_layer(read(), bronze, name, output_format)
        except Exception as error:  # noqa: BLE001 - any failure of one feed is reported, whatever it is
            return str(error)

    errors = side_by_side(*[partial(store, name, read) for name, read in tables.items()], at_once=1)
    return {name: error for name, error in zip(tables, errors) if error is not None}


def raw_readers(spark: SparkSession, raw: str, extensions: dict[str, str] | None = None,
                multi_line: dict[str, bool] | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Readers of the raw tables, by the file extension in which each feed arrives.

    Without `extensions` every CSV, JSON and JSON Lines file of the folder is a table named by its stem; two files of one
    stem are an error, since either would hide the other. `multi_line`
    tells for CSV feeds whether cells go over line ends, where that is known.
    """
    kinds = {
        "csv": lambda name, path: read_csv(spark, path, (multi_line or {}).get(name)),
        "json": lambda name, path: read_json(spark, path),
        "jsonl": lambda name, path: read_json(spark, path, one_array=False),
    }
    if extensions is None:
        files = [name.rsplit(".", 1) for name in feed_names(spark, raw) if name.rsplit(".", 1)[-1] in kinds and "." in name]
        twice = sorted({stem for stem, _ in files if sum(stem == other for other, _ in files) > 1})
        if twice:
            raise ValueError(f"More than one file of the same name: {', '.join(twice)}")
        extensions = dict(files)
    for extension in extensions.values():
        if extension not in kinds:
            raise ValueError(f"Unsupported extension: {extension}")
    return {name: partial(kinds[extension], name, f"{raw}/{name}.{extension}") for name, extension in extensions.items()}


def _tidy(job: Callable) -> Callable:
    """Remove a job's intermediate tables once its outputs are written."""
    @wraps(job)
    def run(spark: SparkSession, *args, **options):
        with removing_tables(spark):
            return job(spark, *args, **options)

    return run


@_tidy
def run_rates(spark: SparkSession, payloads: str, bronze: str, countries: list[str],
              start: date | None = None, end: date | None = None, output_format: str = "parquet") -> None:
    """Completed daily rates for the months with payments."""
    currencies = sorted({COUNTRY_CURRENCY[c] for c in countries if c in COUNTRY_CURRENCY} - {HOME_CURRENCY})
    months = rates.payment_months(read_layer(spark, bronze, "PS_Conta_Receber"))
    quotes = rates.latest_quotes(read_rate_payloads(spark, payloads))
    days = rates.quote_days(months, start, end)
    write_layer(rates.complete_quotes(quotes, days, currencies), bronze, "bcb_cotacoes", output_format)


@_tidy
def run_silver(spark: SparkSession, bronze: str, silver_folder: str, output_format: str = "parquet") -> None:
    """Clean the five tables. Clients come before the receivables that need their currency; without landed rates
    receivables are not converted. Figures of quality, counted while the tables are written, are kept as `QUALITY`."""
    def raw(name: str) -> DataFrame:
        return read_layer(spark, bronze, name)

    def put(parts: list[DataFrame], name: str, source: str, counts: dict[str, Column], **layout) -> list[tuple[str, str, int]]:
        after: Counter[str] = Counter()
        try:
            for i, part in enumerate(parts):
                after.update(write_layer(part, silver_folder, name, output_format, counts=counts, add=i > 0, **layout))
        except Exception:
            remove_layer(spark, silver_folder, name, output_format)  # some parts are not the table
            raise
        # Parquet tells the number of rows without reading them.
        before = raw(source).count()
        figures = {"linhas_antes": before, "linhas_depois": after.pop("linhas"), **after}
        return [(name, figure, n) for figure, n in (figures | {"removidas": before - figures["linhas_depois"]}).items()]

    def put_ledger(clean: Callable[[DataFrame], DataFrame], name: str, source: str, paid: Column, still_open: Column) -> list[tuple[str, str, int]]:
        # Ledgers are large and read by period, so they are stored by month due. Their rows are cleaned one by one, so parts can
        # go one after the other, and what is shuffled at the same time does not grow with the ledger.
        dated = [clean(part).withColumn("mes_vencimento", month_key(F.col("data_vencimento")))
                 for part in read_layer_parts(spark, bronze, source, LEDGER_PART)]
        return put(dated, name, source, {"pagas": F.count_if(paid), "abertas": F.count_if(still_open)},
                   partition_by=["mes_vencimento"], sort_by=["id_conta"])

    def clients() -> list[tuple[str, str, int]]:
        missing = {f"sem_{c}": F.count_if(F.col(c).isNull()) for c in ("pais_cliente", "moeda_pais", "data_cadastro_cliente")}
        return put([silver.clean_clients(raw("PS_Cliente"))], "cliente_silver", "PS_Cliente", missing, sort_by=["id_cliente"])

    def receivables() -> list[tuple[str, str, int]]:
        known = read_layer(spark, silver_folder, "cliente_silver", SILVER["cliente_silver"]) if quotes else None
        return put_ledger(lambda part: silver.clean_receivables(part, known, quotes), "conta_receber_silver", "PS_Conta_Receber",
                          checks.status_like("status_conta", "recebido|pago"), checks.status_like("status_conta", "aberto|pendente"))

    def payables() -> list[tuple[str, str, int]]:
        return put_ledger(silver.clean_payables, "conta_pagar_silver", "PS_Conta_Pagar",
                          checks.status_is("status_conta", "pago"), checks.status_is("status_conta", "em aberto"))

    def targets() -> list[tuple[str, str, int]]:
        filled = reduce(and_, [F.col(c).isNotNull() for c in SILVER["meta_2025_silver"].names])
        return put([silver.clean_targets(raw("PS_Meta2025"))], "meta_2025_silver", "PS_Meta2025",
                   {"validas": F.count_if(filled), "invalidas": F.count_if(~filled)})

    try:
        quotes = read_layer(spark, bronze, "bcb_cotacoes", RATES)
    except FileNotFoundError:
        quotes = None
    figures = side_by_side(
        lambda: clients() + receivables(),
        targets,
        lambda: put([silver.clean_categories(raw("PS_Categoria"))], "categoria_silver", "PS_Categoria", {}, sort_by=["codigo_categoria"]),
        payables,
    )
    rows = [figure for table in figures for figure in table]
    write_layer(spark.createDataFrame(rows, "tabela string, medida string, linhas bigint").coalesce(1), silver_folder, QUALITY, output_format)


def _silver_inputs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_layer(spark, folder, name, schema) for name, schema in SILVER.items()}


@_tidy
def run_gold(spark: SparkSession, silver_folder: str, gold: str, output_format: str = "parquet",
             existing: Star | None = None) -> Star:
    """Write the star schema and return it as read back. Ledger facts lie in directories by month due. Rows that
    `existing` holds keep their keys."""
    t = _silver_inputs(spark, silver_folder)
    star = build_star(t["cliente_silver"], t["categoria_silver"], t["meta_2025_silver"], t["conta_pagar_silver"],
                      t["conta_receber_silver"], existing)
    due = star.dim_data.select(F.col("sk_data").alias("sk_data_vencimento"), month_key(F.col("data_calendario")).alias("mes_vencimento"))
    for name, df in star.tables().items():
        if name in ("fato_conta_receber", "fato_conta_pagar"):
            write_layer(lookup_join(df, due, ["sk_data_vencimento"]), gold, name, output_format, partition_by=["mes_vencimento"])
        else:
            write_layer(df, gold, name, output_format)
    return Star(**{name: read_layer(spark, gold, name, GOLD[name]) for name in star.tables()})


@_tidy
def run_segments(spark: SparkSession, silver_folder: str, ml: str, restarts: int = segments.RESTARTS) -> None:
    """Write features, the comparison of models, and the segmented clients. Without clients the tables are empty."""
    t = _silver_inputs(spark, silver_folder)
    write_layer(
        customers.client_features(t["cliente_silver"], t["conta_receber_silver"], t["categoria_silver"]),
        ml, "features_cliente",
    )
    features = read_layer(spark, ml, "features_cliente")
    mix = customers.category_mix(t["conta_receber_silver"], t["categoria_silver"])
    chosen = segments.compare_clusterings(features, restarts=restarts, mix=mix)
    write_layer(chosen.comparison, ml, "model_comparison")
    write_layer(segments.segment_output(features, chosen.labels, chosen.winner), ml, "cliente_clusterizado")

"""Landed answers of the exchange-rate service."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import ORDINAL
from ..schemas import RATE_PAYLOAD


def read_rate_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per quote. Answers lie in one folder per currency (`moeda=USD/...json`), one document per file."""
    documents = spark.read.schema(RATE_PAYLOAD).option("multiLine", True).option("basePath", path).json(path)
    located = documents.withColumn("__file", F.col("_metadata.file_path"))
    return flatten_payloads(located, "moeda", "__file")


def flatten_payloads(documents: DataFrame, currency: str, *order: str) -> DataFrame:
    """Explode `value`, keeping the position inside the document as arrival order."""
    quotes = documents.select(F.col(currency).alias("moeda"), *order, F.posexplode("value").alias("__at", "__quote"))
    return quotes.select(
        "moeda",
        F.col("__quote.dataHoraCotacao").alias("data_hora_cotacao"),
        F.col("__quote.cotacaoCompra").alias("cotacao_compra"),
        F.col("__quote.cotacaoVenda").alias("cotacao_venda"),
        F.struct(*order, "__at").alias(ORDINAL),
    )

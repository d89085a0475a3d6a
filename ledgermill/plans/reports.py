"""Summaries of features and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import quantile, value_positions
from ..operators.sketches import exact_quantiles, quantile_columns, value_sketch
from ..sources.shared import materialise

SUMMARY_FEATURES = [
    "recencia_dias", "frequencia_recebimentos", "valor_total_recebido_brl", "taxa_pagamento_em_dia",
    "taxa_pagamento_atrasado",
]


def tercile_cutoffs(features: DataFrame, value: str = "valor_total_recebido_brl") -> DataFrame:
    return value_positions(features, value).agg(
        quantile(value, 1 / 3).alias("corte_1"), quantile(value, 2 / 3).alias("corte_2")
    )


def band_statistics(features: DataFrame, band: str = "faixa_valor_cliente",
                    value: str = "valor_total_recebido_brl") -> DataFrame:
    """Count, mean, median and extremes of a value per band."""
    positions = value_positions(features, value, [band])
    return positions.groupBy(band).agg(
        F.sum("eq").alias("clientes"),
        (F.sum(F.col(value) * F.col("eq")) / F.sum("eq")).alias("media"),
        quantile(value, 0.5).alias("mediana"),
        F.min(value).alias("minimo"),
        F.max(value).alias("maximo"),
    )


def share(part: Column, whole: Column) -> Column:
    """Percentage with one decimal; null for an empty whole."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 1)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs, and its percentage, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("linhas"))
    total = counts.agg(F.sum("linhas")).scalar()
    return counts.withColumn("percentual", share(F.col("linhas"), total)).orderBy(F.desc("linhas"), column)


def crosstab(df: DataFrame, row: str, column: str, values: list, rest: str = "Outros", total: str = "All") -> DataFrame:
    """Counts by two attributes with totals in both directions; the total row is the last.

    Values of `column` that are not listed are counted together as `rest`, so cells add up to their totals. Listed values may not
    be called as the rest or the total are; data that holds such values is counted right.
    """
    if {rest, total} & {str(value) for value in values}:
        raise ValueError(f"Choose other labels than {rest} and {total}")
    place = F.lit(len(values))
    for i, value in enumerate(values):
        place = F.when(F.col(column) == F.lit(value), i).otherwise(place)
    cells = (
        df.where(F.col(row).isNotNull() & F.col(column).isNotNull()).select(row, place.alias("__place"))
        .cube(row, "__place").agg(F.count(F.lit(1)).alias("n"), F.grouping(row).alias("__all_rows"),
                                  F.grouping("__place").alias("__all_columns"))
    )
    label = F.when(F.col("__all_rows") == 1, F.lit(total)).otherwise(F.col(row).cast("string"))
    where = F.when(F.col("__all_columns") == 1, len(values) + 1).otherwise(F.col("__place"))
    wide = (
        cells.select("__all_rows", label.alias(row), where.alias("__place"), "n")
        .groupBy("__all_rows", row).pivot("__place", list(range(len(values) + 2))).agg(F.sum("n"))
        .toDF("__all_rows", row, *map(str, values), rest, total)
    )
    return wide.fillna(0).orderBy("__all_rows", row).drop("__all_rows")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def first_rows(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """Preview of a table."""
    return df.orderBy(*order).limit(n)


def segment_profile(segmented: DataFrame) -> DataFrame:
    """Size and mean behaviour per segment, the mix of value bands, and the label of its first client."""
    def band_share(band: str) -> Column:
        return share(F.count_if(F.col("faixa_valor_cliente") == band), F.count(F.lit(1)))

    return segmented.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("clientes"),
        F.avg("recencia_dias").alias("recencia_media"),
        F.avg("frequencia_recebimentos").alias("frequencia_media"),
        F.avg("valor_total_recebido_brl").alias("valor_medio"),
        (F.lit(100.0) * F.avg("taxa_pagamento_em_dia")).alias("em_dia_pct"),
        band_share("muito_alto_valor").alias("pct_muito_alto_valor"),
        band_share("alto_valor").alias("pct_alto_valor"),
        band_share("medio_baixo_valor").alias("pct_medio_baixo_valor"),
        F.min_by("perfil_cluster", "id_cliente").alias("perfil_exemplo"),
    )


def _by_feature(segmented: DataFrame, features: list[str]) -> DataFrame:
    values = segmented.select("cluster", *[F.col(f).cast("double").alias(f) for f in features])
    return values.unpivot(["cluster"], features, "atributo", "valor")


def five_numbers_by_sketch(segmented: DataFrame, features: list[str] = SUMMARY_FEATURES) -> DataFrame:
    """As `five_numbers`, but a sketch tells where the quartiles lie, and only the values around them are ordered."""
    by, long = ["cluster", "atributo"], _by_feature(segmented, features)
    sketch = materialise(value_sketch(long, "valor", by))
    ends = sketch.groupBy(*by).agg(F.min("menor").alias("minimo"), F.max("maior").alias("maximo"))
    quartiles = exact_quantiles(long, "valor", [0.25, 0.5, 0.75], sketch, by)
    return ends.join(quantile_columns(quartiles, by, {0.25: "q1", 0.5: "mediana", 0.75: "q3"}), by).select(
        *by, "minimo", "q1", "mediana", "q3", "maximo")


def five_numbers(segmented: DataFrame, features: list[str] = SUMMARY_FEATURES) -> DataFrame:
    """Minimum, quartiles and maximum of each feature per segment."""
    long = _by_feature(segmented, features)
    positions = value_positions(long, "valor", ["cluster", "atributo"])
    return positions.groupBy("cluster", "atributo").agg(
        F.min("valor").alias("minimo"),
        quantile("valor", 0.25).alias("q1"),
        quantile("valor", 0.5).alias("mediana"),
        quantile("valor", 0.75).alias("q3"),
        F.max("valor").alias("maximo"),
    )


def centroids(projected: DataFrame, axes: list[str]) -> DataFrame:
    """Mean position of each segment."""
    return projected.groupBy("cluster").agg(*[F.avg(a).alias(a) for a in axes])

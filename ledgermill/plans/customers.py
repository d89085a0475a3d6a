"""Behaviour of clients: recency, frequency, value, delays, category mix, value band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import NEVER_PAID_DAYS, VALUE_BANDS
from ..functions.money import exact, stable_sum, to_identifier, to_number
from ..functions.text import column_suffix, strip_column
from ..operators.headers import tidy_headers
from ..operators.lookups import lookup_join
from ..operators.ordering import average_rank, value_positions
from ..sources.shared import materialise

# Categories with a column of their own in the wide form, the most common ones; all others share the rest column.
MIX_COLUMNS = 256
MIX_REST = "mix_resto"

_BASE = ["id_cliente", "nome_cliente", "pais_cliente", "moeda_pais", "data_cadastro_cliente"]


def _receivables(receivables: DataFrame) -> DataFrame:
    df = to_identifier(tidy_headers(receivables), "id_cliente").where("id_cliente is not null")
    df = to_number(df, "valor_conta_brl")
    return df.withColumns({c: F.col(c).cast("date") for c in ("data_pagamento", "data_vencimento")})


def client_totals(receivables: DataFrame) -> DataFrame:
    """One row per client with counts, sums and moments.

    Receivables are first summed per client and status, which gives the counts the most common status needs; both
    steps combine inside each partition before the shuffle, so a client with very many entries is no burden. The
    totals are written once, since the latest payment of all clients is needed before the first row.
    """
    df = _receivables(receivables)
    delay = F.coalesce(F.datediff("data_pagamento", "data_vencimento"), F.lit(0)).cast("bigint")
    rows = df.select(
        "id_cliente", strip_column(F.col("status_conta")).alias("status"), "id_conta", "valor_conta_brl",
        "data_pagamento", delay.alias("dias"),
    )
    per_status = rows.groupBy("id_cliente", "status").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count("id_conta").alias("contas"),
        F.count("valor_conta_brl").alias("valores"),
        F.try_sum(exact(F.col("valor_conta_brl"))).alias("total"),
        F.max("data_pagamento").alias("ultimo_pagamento"),
        F.sum("dias").alias("dias"),
        F.sum(F.col("dias").cast("double") * F.col("dias")).alias("dias2"),
        F.count_if(F.col("dias") <= 0).alias("em_dia"),
    )
    # Most rows first, then the smallest text; null statuses do not take part.
    commonness = F.when(F.col("status").isNotNull(), F.struct(-F.col("linhas"), F.col("status").alias("status")))
    return materialise(per_status.groupBy("id_cliente").agg(
        *[F.sum(c).alias(c) for c in ("linhas", "contas", "valores", "dias", "dias2", "em_dia")],
        stable_sum(F.col("total")).alias("total"),
        F.max("ultimo_pagamento").alias("ultimo_pagamento"),
        F.min(commonness)["status"].alias("status"),
    ))


def _rfm_columns(totals: DataFrame) -> list[Column]:
    latest = F.coalesce(totals.agg(F.max("ultimo_pagamento")).scalar(), F.current_date())
    recency = F.datediff(latest, F.col("ultimo_pagamento"))
    return [
        F.col("contas").alias("frequencia_recebimentos"),
        F.coalesce("total", F.lit(0.0)).alias("valor_total_recebido_brl"),
        (F.col("total") / F.nullif(F.col("valores"), F.lit(0))).alias("valor_medio_recebido_brl"),
        F.col("ultimo_pagamento"),
        F.coalesce("status", F.lit("sem_status")).alias("status_mais_comum"),
        F.coalesce(recency, F.lit(NEVER_PAID_DAYS)).cast("double").alias("recencia_dias"),
    ]


def _behaviour_columns() -> list[Column]:
    n, days = F.col("linhas"), F.col("dias").cast("double")
    spread = F.greatest(F.col("dias2") - days * days / n, F.lit(0.0))
    variance = F.when(n > 1, spread / F.nullif(n - 1, F.lit(0)))
    return [
        (days / n).alias("media_dias_atraso"),
        variance.alias("variancia_dias_atraso"),
        F.sqrt(variance).alias("desvio_dias_atraso"),
        (F.col("em_dia") / n).alias("taxa_pagamento_em_dia"),
        ((n - F.col("em_dia")) / n).alias("taxa_pagamento_atrasado"),
    ]


def client_rfm(totals: DataFrame) -> DataFrame:
    """Recency against the latest payment of all clients, frequency, value and most common status."""
    return totals.select("id_cliente", *_rfm_columns(totals))


def client_behaviour(totals: DataFrame) -> DataFrame:
    """Mean, variance and deviation of the delay in days, and the shares paid on time and late."""
    return totals.select("id_cliente", *_behaviour_columns())


def category_mix(receivables: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """Long form of the mix: the share of each category in a client's receivables.

    Without `categories` the codes serve as names. Names that give the same column name count as one.
    """
    df = _receivables(receivables)
    pairs = df.groupBy("id_cliente", "codigo_categoria").agg(F.count(F.lit(1)).alias("linhas"))
    if categories is None:
        pairs = pairs.withColumn("nome_categoria", F.col("codigo_categoria"))
    else:
        names = tidy_headers(categories).select("codigo_categoria", "nome_categoria")
        pairs = lookup_join(pairs, names, ["codigo_categoria"])
    named = pairs.groupBy("id_cliente", column_suffix(F.col("nome_categoria")).alias("categoria")).agg(
        F.sum("linhas").alias("linhas")
    )
    total = F.sum("linhas").over(Window.partitionBy("id_cliente"))
    return named.withColumn("parcela", F.col("linhas") / total)


def common_categories(mix: DataFrame, most: int = MIX_COLUMNS) -> list[str]:
    """Names of the categories that most clients have, in the order of names."""
    counts = mix.groupBy("categoria").agg(F.count(F.lit(1)).alias("clientes"))
    return sorted(row[0] for row in counts.orderBy(F.desc("clientes"), "categoria").limit(most).collect())


def mix_columns(mix: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Wide form: one `mix_cat_` column per name, zero where a client has none of it, and the share of all categories
    that are not named in `mix_resto`, so a client's shares always add up to one."""
    if names is None:
        mix = materialise(mix)
        names = common_categories(mix)
    column = F.when(F.col("categoria").isin(names), F.concat(F.lit("mix_cat_"), "categoria")).otherwise(MIX_REST)
    columns = [*[f"mix_cat_{n}" for n in names], MIX_REST]
    wide = mix.groupBy("id_cliente", column.alias("coluna")).agg(F.sum("parcela").alias("parcela")).groupBy(
        "id_cliente").pivot("coluna", columns).agg(F.first("parcela"))
    return wide.select("id_cliente", *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(c) for c in columns])


def band_limits(clients: DataFrame, value: str) -> tuple[Column, Column]:
    """Smallest values of the middle and the top band.

    Bands follow the percentile rank, equal values sharing the mean of their ranks: above one third, above two
    thirds. Rank grows with value, so two limits decide the band, and no client needs its own rank. Comparing
    `3 * rank` with whole numbers keeps ranks of exactly a third on the lower side.
    """
    positions = value_positions(clients, value)
    above = F.col("less") * 6 + F.col("eq") * 3 + 3

    smallest = [F.min(F.when(above > F.col("total") * 2 * thirds, F.col(value))) for thirds in (1, 2)]
    both = positions.agg(F.array(*smallest).alias("limites")).scalar()
    return both[0], both[1]


def value_band(value: Column, middle: Column, top: Column) -> Column:
    low, mid, high = VALUE_BANDS
    return F.when(value >= top, high).when(value >= middle, mid).otherwise(low)


def percentile_ranks(clients: DataFrame, value: str) -> DataFrame:
    """Each row with the percentile rank of its value, equal values sharing the mean of their ranks."""
    ranks = value_positions(clients, value).select(value, (average_rank() / F.col("total")).alias("rank_pct"))
    return lookup_join(clients, ranks, [value])


def client_features(clients: DataFrame, receivables: DataFrame, categories: DataFrame | None = None,
                    mix_names: list[str] | None = None, with_mix: bool = True) -> DataFrame:
    """The feature table: one row per client, also for clients without receivables."""
    base = to_identifier(tidy_headers(clients), "id_cliente").where("id_cliente is not null").select(*_BASE)
    totals = client_totals(receivables)
    behaviour = totals.select("id_cliente", *_rfm_columns(totals), *_behaviour_columns())
    df = base.join(behaviour, "id_cliente", "left")
    if with_mix:
        df = df.join(mix_columns(category_mix(receivables, categories), mix_names), "id_cliente", "left")

    numbers = [f.name for f in df.schema.fields if f.dataType.typeName() in ("long", "double")]
    df = df.fillna(0, [c for c in numbers if c != "id_cliente"]).fillna({
        "status_mais_comum": "sem_status", "pais_cliente": "DESCONHECIDO", "moeda_pais": "DESCONHECIDA",
    })
    for amount in ("valor_total_recebido_brl", "valor_medio_recebido_brl"):
        df = df.withColumn(f"{amount}_log1p", F.log1p(F.greatest(F.col(amount), F.lit(0.0))))

    # Written once: the band needs the values of all clients before it can label the first.
    return with_value_band(materialise(df))


def with_value_band(features: DataFrame, value: str = "valor_total_recebido_brl") -> DataFrame:
    middle, top = band_limits(features.select(value), value)
    return features.withColumn("faixa_valor_cliente", value_band(F.col(value), middle, top))


def profile_label() -> Column:
    """Short description of a client from its features."""
    band = F.lower(F.trim("faixa_valor_cliente"))
    by_value = F.when(F.col("valor_total_recebido_brl") >= 100_000, VALUE_BANDS[1]).otherwise(VALUE_BANDS[0])
    return F.concat_ws(
        "|",
        F.when(F.col("recencia_dias") <= 60, "recente").otherwise("inativo"),
        F.when(F.col("frequencia_recebimentos") >= 20, "alta_frequencia").otherwise("baixa_frequencia"),
        F.when(band.isin(VALUE_BANDS), band).otherwise(by_value),
        F.when(F.col("taxa_pagamento_em_dia") >= 0.7, "bom_pagador").otherwise("atrasa_pagamento"),
    )

"""Segmentation of clients: candidate clusterings, their quality, and the choice among them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clustering
from ..operators.lookups import lookup_join
from ..operators.ordering import dense_key
from ..schemas import MODEL_METRICS
from ..sources.shared import materialise
from .customers import MIX_REST, profile_label

CLUSTER_COUNTS = range(2, 9)
RESTARTS = 20
SEED = 42

# Metrics of a labelling with fewer than two clusters.
DEGENERATE = {"silhouette": -1.0, "davies_bouldin": 999999.0, "calinski_harabasz": 0.0}

_NOT_FEATURES = {"id_cliente", "nome_cliente", "data_cadastro_cliente"}
_ABSENT = "ausente"


def feature_vectors(features: DataFrame, include_last_payment: bool = False, mix: DataFrame | None = None) -> DataFrame:
    """`id_cliente` and the sparse vector `features` (`size`, `indices`, `values`): numbers standardised by population
    deviation, texts one-hot encoded.

    Constant numbers are only centred. Every level of every text column has an entry of its own, after the numbers, in
    the order of columns and levels; levels are numbered in a written table, which the rows are joined with, so their
    number is not bounded. A missing text is a level too.

    With the long form of the category mix, every category has an entry after those, divided by its deviation over all
    clients; the wide columns of the mix are then left out. Entries of the mix are not centred, so that they stay
    sparse: distances between clients and axes of centred vectors are the same.
    """
    df = features if mix is None else features.drop(*[c for c in features.columns if c.startswith("mix_cat_") or c == MIX_REST])
    if include_last_payment:
        df = df.withColumn("ultimo_pagamento", F.date_format("ultimo_pagamento", "yyyy-MM-dd"))
    used = [f for f in df.schema.fields if f.name not in _NOT_FEATURES]
    numbers = [f.name for f in used if isinstance(f.dataType, T.NumericType)]
    texts = [f.name for f in used if isinstance(f.dataType, T.StringType)]
    df = df.fillna(_ABSENT, texts) if texts else df

    # One row of two figures per column.
    row = df.agg(F.count(F.lit(1)), *[F.avg(c).alias(f"m_{c}") for c in numbers], *[F.stddev_pop(c).alias(f"s_{c}") for c in numbers]).first()
    scaled = [F.coalesce((F.col(c) - (row[f"m_{c}"] or 0.0)) / (row[f"s_{c}"] or 1.0), F.lit(0.0)).cast("double") for c in numbers]
    df = df.select("id_cliente", *texts, F.array(*scaled).cast("array<double>").alias("__numbers"))
    size, places = len(numbers), []
    if texts:
        each = F.explode(F.array(*[F.struct(F.lit(i).alias("coluna"), F.col(c).alias("nivel")) for i, c in enumerate(texts)]))
        levels = materialise(dense_key(df.select(each.alias("um")).select("um.*").distinct(), "posicao", ["coluna", "nivel"]))
        size += levels.count()
        for i, c in enumerate(texts):
            own = levels.where(F.col("coluna") == i).select(F.col("nivel").alias(c), F.col("posicao").alias(f"__at_{i}"))
            df = lookup_join(df, own, [c], "inner")
            places.append((F.col(f"__at_{i}") + (len(numbers) - 1)).cast("int"))
    indices = F.concat(F.array(*[F.lit(i) for i in range(len(numbers))]).cast("array<int>"), F.array(*places).cast("array<int>"))
    values = F.concat("__numbers", F.array(*[F.lit(1.0) for _ in texts]).cast("array<double>"))
    if mix is not None:
        shares, categories = _mix_entries(mix, max(1, row[0]), size)
        df = lookup_join(df, shares, ["id_cliente"])
        size += categories
        none = F.array().cast("array<struct<posicao:int,valor:double>>")
        indices = F.concat(indices, F.coalesce("__mix", none)["posicao"])
        values = F.concat(values, F.coalesce("__mix", none)["valor"])
    return df.select("id_cliente", F.struct(F.lit(size).alias("size"), indices.alias("indices"), values.alias("values")).alias("features"))


def _mix_entries(mix: DataFrame, clients: int, begin: int) -> tuple[DataFrame, int]:
    """For each client the entries of its categories, from `begin` on in the order of their names, and the number of categories."""
    mix = materialise(mix.select("id_cliente", "categoria", "parcela"))
    mean = F.sum("parcela") / clients
    deviation = F.sqrt(F.greatest(F.sum(F.col("parcela") ** 2) / clients - mean ** 2, F.lit(0.0)))
    names = materialise(dense_key(mix.groupBy("categoria").agg(deviation.alias("desvio")), "posicao", ["categoria"]))
    placed = lookup_join(mix, names, ["categoria"], "inner", null_safe=True)
    one = F.struct((F.col("posicao") + (begin - 1)).cast("int").alias("posicao"),
                   (F.col("parcela") / F.when(F.col("desvio") > 0, F.col("desvio")).otherwise(1.0)).cast("double").alias("valor"))
    # At most one entry for each category.
    return placed.groupBy("id_cliente").agg(F.sort_array(F.collect_list(one)).alias("__mix")), names.count()


def entries(vectors: DataFrame) -> DataFrame:
    """Long form of sparse vectors: one row for each entry that is not zero."""
    each = F.explode(F.arrays_zip("features.indices", "features.values"))
    return vectors.select("id_cliente", each.alias("um")).select(
        "id_cliente", F.col("um.indices").alias("posicao"), F.col("um.values").alias("valor")).where("valor != 0")


def dense(features: Column) -> Column:
    """A sparse vector as a dense one of Spark's machine learning library, for narrow vectors."""
    held = F.map_from_arrays(features["indices"], features["values"])
    every = F.when(features["size"] > 0, F.sequence(F.lit(0), features["size"] - 1)).otherwise(F.array().cast("array<int>"))
    return array_to_vector(F.transform(every, lambda i: F.coalesce(F.try_element_at(held, i), F.lit(0.0))))


def labelling_metrics(labelled: DataFrame, name: str, label: str = "cluster", features: str = "features") -> dict:
    """Quality of a labelling; rows labelled -1 are noise and only counted.

    Silhouette is the squared-Euclidean one, which needs sums per cluster instead of all pairs. What reaches the
    driver is one row per cluster.
    """
    clean = labelled.where(F.col(label) >= 0)
    stats = clean.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        Summarizer.mean(F.col(features)).alias("centre"),
        Summarizer.normL2(F.col(features)).alias("norm"),
    ).collect()
    total = labelled.count()
    n = sum(row["n"] for row in stats)
    result = {"model_name": name, "n_clusters": len(stats), "noise_ratio": (total - n) / total if total else 0.0}
    if len(stats) < 2:
        return result | DEGENERATE

    centres = {row[label]: row["centre"].toArray() for row in stats}
    overall = sum(row["n"] * centres[row[label]] for row in stats) / n
    between = sum(row["n"] * ((centres[row[label]] - overall) ** 2).sum() for row in stats)
    within = sum(
        (row["norm"].toArray() ** 2).sum() - row["n"] * (centres[row[label]] ** 2).sum() for row in stats
    )
    k = len(stats)
    calinski = between * (n - k) / (within * (k - 1)) if within > 0 else 1.0

    centre_table = clean.sparkSession.createDataFrame(
        [(int(c), [float(x) for x in v]) for c, v in centres.items()], f"{label} int, __centre array<double>"
    )
    gap = F.zip_with(vector_to_array(features), "__centre", lambda a, b: (a - b) * (a - b))
    distance = F.sqrt(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x))
    # One row per cluster on the small side.
    spread = {
        row[label]: row["d"]
        for row in clean.join(F.broadcast(centre_table), label).groupBy(label).agg(F.avg(distance).alias("d")).collect()
    }

    def likeness(a: int, b: int) -> float:
        apart = float(((centres[a] - centres[b]) ** 2).sum() ** 0.5)
        return (spread[a] + spread[b]) / apart if apart else 0.0

    davies = sum(max(likeness(a, b) for b in centres if b != a) for a in centres) / k
    evaluator = ClusteringEvaluator(featuresCol=features, predictionCol=label, metricName="silhouette")
    silhouette = evaluator.evaluate(clean.withColumn(label, F.col(label).cast("double")))
    return result | {
        "silhouette": float(silhouette), "davies_bouldin": float(davies), "calinski_harabasz": float(calinski),
    }


def rank_models(metrics: DataFrame) -> DataFrame:
    """Rank candidates by three metrics, equal values sharing the mean rank; the score is one over the rank sum.

    There is one row per candidate model, so ranking them in one task is fine.
    """
    everything = Window.partitionBy()

    def rank(column: str, order) -> F.Column:
        ties = F.count(F.lit(1)).over(Window.partitionBy(column))
        return F.rank().over(everything.orderBy(order)) + (ties - 1) / 2

    ranked = metrics.withColumns({
        "rank_silhouette": rank("silhouette", F.desc("silhouette")),
        "rank_davies_bouldin": rank("davies_bouldin", F.asc("davies_bouldin")),
        "rank_calinski_harabasz": rank("calinski_harabasz", F.desc("calinski_harabasz")),
    })
    ranks = F.col("rank_silhouette") + F.col("rank_davies_bouldin") + F.col("rank_calinski_harabasz")
    return ranked.withColumn("ranking_score", F.lit(1.0) / ranks)


def top_models(ranked: DataFrame, n: int = 5) -> DataFrame:
    """The best candidates; equal scores are ordered by name."""
    return ranked.orderBy(F.desc("ranking_score"), "model_name").limit(n)


@dataclass
class Segmentation:
    comparison: DataFrame
    winner: str
    labels: DataFrame
    vectors: DataFrame


def candidates(rows: clustering.Rows, counts=CLUSTER_COUNTS, restarts: int = RESTARTS) -> dict[str, clustering.Labelling]:
    """The best k-means run and the cut of Ward's hierarchy for each number of clusters up to that of the rows."""
    possible = [k for k in counts if k <= rows.count]
    runs = clustering.best_runs(clustering.kmeans_runs(rows, possible, restarts, SEED))
    found: dict[str, clustering.Labelling] = {
        f"kmeans_k{k}": (run.centres, np.arange(len(run.centres))) for k, run in runs.items()}
    if possible:
        tree = clustering.ward_hierarchy(rows, possible)
        found |= {f"agglomerative_k{k}": (tree.seeds, labels) for k, labels in tree.labels.items()}
    return found


def compare_clusterings(features: DataFrame, counts=CLUSTER_COUNTS, restarts: int = RESTARTS,
                        include_last_payment: bool = False, mix: DataFrame | None = None) -> Segmentation:
    """Fit k-means and Ward's hierarchy for each number of clusters, rank them, and label with the best.

    All k-means runs are fitted in the same passes over the written vectors, the hierarchy is built once for all counts, and
    the figures of all candidates come from two more passes. K-means is restarted and keeps the run
    of least cost. The winner is not fitted again. Counts beyond the number of clients cannot be fitted; they are listed
    with the figures of a degenerate labelling. Where none can be fitted, clients form one cluster.
    """
    vectors = materialise(feature_vectors(features, include_last_payment, mix))
    rows = clustering.Rows.of(vectors)
    found = candidates(rows, counts, restarts)
    figures = clustering.labelling_figures(rows, found)
    names = [f"{family}_k{k}" for family in ("kmeans", "agglomerative") for k in counts]
    # Figures that were not found are those of a degenerate labelling.
    metrics = [DEGENERATE | {"model_name": name, "noise_ratio": 0.0, "n_clusters": rows.count} | figures.get(name, {}) for name in names]
    table = [tuple(one[f] for f in MODEL_METRICS.fieldNames()) for one in metrics]
    comparison = rank_models(features.sparkSession.createDataFrame(table, MODEL_METRICS))
    winner = top_models(comparison, 1).first()["model_name"]
    if winner in found:
        labels = clustering.labelled(rows, found[winner]).withColumnRenamed("key", "id_cliente")
    else:
        labels = vectors.select("id_cliente", F.lit(0).alias("cluster"))
    return Segmentation(comparison, winner, labels, vectors)


def segment_output(features: DataFrame, labels: DataFrame, winner: str) -> DataFrame:
    """Clients with their segment, main figures, a descriptive label and the chosen model."""
    df = features.join(labels, "id_cliente", "left")
    return df.select(
        "id_cliente", "nome_cliente", "pais_cliente", "moeda_pais", "cluster", "recencia_dias",
        "frequencia_recebimentos", "valor_total_recebido_brl", "faixa_valor_cliente", "taxa_pagamento_em_dia",
        "taxa_pagamento_atrasado", profile_label().alias("perfil_cluster"), F.lit(winner).alias("modelo_vencedor"),
    )


def project_2d(vectors: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[float]]:
    """Clients on the two main axes of their centred vectors, and the share of variance each axis explains."""
    rows = clustering.Rows.of(vectors)
    mean, axes, shares = clustering.main_axes(rows, 2)
    placed = clustering.on_axes(rows, mean, axes, ["pc1", "pc2"]).withColumnRenamed("key", "id_cliente")
    return placed.join(labels, "id_cliente", "inner"), [float(x) for x in shares]

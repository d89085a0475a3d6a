from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ledgermill.functions.money import exact, stable_sum
from ledgermill.operators.dedup import ORDINAL
from ledgermill.plans import customers, rates, reports, segments, silver, star
from ledgermill.schemas import MODEL_METRICS

from .conftest import rows


def d(day, month=1):
    return date(2025, month, day)


def table(spark, columns, *values):
    """All-text table with an arrival order."""
    schema = ", ".join(f"{c} string" for c in columns.split()) + f", {ORDINAL} int"
    return spark.createDataFrame([(*v, i) for i, v in enumerate(values)], schema)


# --- silver ---------------------------------------------------------------------------------------------------------

def test_targets(spark):
    raw = table(spark, "mes_meta meta", ("01/2025", "700k"), (" março de 2025", "750k"), ("ago./2025", "750k"),
                ("13/2025", "1,5k"), ("2025", "1.5k"), (None, "abc"))
    assert rows(silver.clean_targets(raw), ORDINAL) == [
        (d(1), 700000.0, 1, 2025, "janeiro", 0), (d(1, 3), 750000.0, 3, 2025, "marco", 1),
        (d(1, 8), 750000.0, 8, 2025, "agosto", 2), (None, 1500.0, 13, 2025, None, 3),
        (None, 15000.0, None, 2025, None, 4), (None, None, None, None, None, 5)]


def test_categories(spark):
    raw = table(
        spark, "codigo_categoria nome_categoria tipo_categoria",
        ("1.1.06", None, "receita"), (None, "VARIAÇÃO CAMBIAL ATIVA", "RECEITA"), ("1.1.08", "JUROS RECEBIDOS", None),
        ("1.1.06", "RECEITA FINANCEIRA SOBRE APLICAÇÕES", "receita"), ("1.1.08", "JUROS RECEBIDOS", "ReceitA"),
        ("3.1.13", "SOFTWARE / LICENÇA DE USO", "Despesa"), ("  ", "x", "y"), ("3.1.13 ", "later", "z"))
    assert rows(silver.clean_categories(raw)) == [
        ("1.1.06", "RECEITA FINANCEIRA SOBRE APLICACOES", "RECEITA"), ("1.1.08", "JUROS RECEBIDOS", "RECEITA"),
        ("3.1.13", "SOFTWARE LICENCA DE USO", "DESPESA")]


def test_clients(spark):
    raw = table(spark, "id_cliente NOME_CLIENTE pais_cliente data_cadastro_cliente",
                ("2.0", " maria  DA silva", "FranÃ§a", "12/01/2023"), ("x", "a", "b", "c"),
                ("1", None, "Chile", "29/02/2023"))
    assert rows(silver.clean_clients(raw), "id_cliente") == [
        (1, None, "CHILE", None, None, 2), (2, "Maria da Silva", "FRANCA", "EUR", date(2023, 1, 12), 0)]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="missing meta"):
        silver.clean_targets(table(spark, "mes_meta", ("01/2025",)))


LEDGER = "id_conta descricao_conta id_cliente codigo_categoria valor_conta data_vencimento data_pagamento"


def test_payables(spark):
    raw = table(spark, LEDGER.replace("id_cliente", "destino_pagamento_conta") + " status_conta",
                ("1", "a", "x", "c", "10.5", "29/02/2025", "", "Pago"), ("x", "a", "x", "c", "1", "", "", ""),
                ("2", "a", "x", "c", "abc", "", "", ""))
    assert rows(silver.clean_payables(raw)) == [
        (1, "a", "x", "c", None, 10.5, 10.5, d(28, 2), None, "Pago", 0)]


@pytest.fixture(scope="module")
def clients(spark):
    raw = table(spark, "id_cliente nome_cliente pais_cliente data_cadastro_cliente",
                ("1", "Ana", "Brasil", "2023-01-01"), ("2", "Bo", "USA", "2023-01-01"),
                ("3", "Cy", "Argentina", "2023-01-01"), ("4", "Di", "Chile", ""), ("2", "Bo again", "Canada", ""))
    return silver.clean_clients(raw)


@pytest.fixture(scope="module")
def sell_rates(spark):
    return spark.createDataFrame([("USD", d(2), 5.0, 5.1), ("USD", d(3), 5.0, 5.1), ("CAD", d(3), 3.0, 3.1)],
                                 "moeda string, data date, cotacao_compra double, cotacao_venda double")


def test_receivables_are_converted(spark, clients, sell_rates):
    paid = ["2025-01-03", "2025-01-03", "2025-01-03", "2025-01-03", "2025-01-03", "2025-01-01", "", "", "03/01/2025"]
    owners = ["1", "2", "3", "4", "99", "2", "2", "3", "2.0"]
    raw = table(spark, LEDGER + " status", *[
        (str(i), "t", o, "c", "100", "2025-01-01", p, "s") for i, (o, p) in enumerate(zip(owners, paid))])
    got = {r.id_conta: r.valor_conta_brl for r in silver.clean_receivables(raw, clients, sell_rates).collect()}
    assert [got[k] for k in sorted(got)] == pytest.approx([100, 510, 0.37, 100, 100, 100, 100, 100, 510])
    plain = silver.clean_receivables(raw)
    assert {r.valor_conta_brl for r in plain.collect()} == {100.0}
    assert plain.first().status_conta == "s"


# --- rates ----------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def quotes(spark):
    return spark.createDataFrame([
        ("USD", "2025-01-02 10:00:00.000", 4.9, 5.0, 1), ("USD", "2025-01-02 13:00:00.000", 5.0, 5.1, 2),
        ("USD", "2025-01-02 13:00:00.000", 9.0, 9.1, 3), ("USD", "2025-01-04 13:00:00.000", 5.1, 5.2, 4),
        ("USD", None, 7.0, 7.0, 5), ("USD", "", 7.0, 7.0, 6),
    ], f"moeda string, data_hora_cotacao string, cotacao_compra double, cotacao_venda double, {ORDINAL} int")


def test_quotes_are_completed(spark, quotes):
    latest = rates.latest_quotes(quotes)
    assert rows(latest, "data") == [("USD", d(2), 5.0, 5.1), ("USD", d(4), 5.1, 5.2)]
    days = spark.createDataFrame([(d(i),) for i in range(1, 5)], "data date")
    full = rates.complete_quotes(latest, days, ["USD", "EUR"])
    assert rows(full.select("moeda", "data", "cotacao_venda"), "data") == [
        ("USD", d(2), 5.1), ("USD", d(3), 5.1), ("USD", d(4), 5.2)]
    assert tuple(rates.quote_counts(latest, full).first()) == (2, 3)


def test_days_to_quote(spark):
    raw = table(spark, "data_pagamento", ("2025-01-03",), ("10/03/2025",), ("29/02/2025",), ("x",))
    months = rates.payment_months(raw)
    assert rows(months) == [(d(1),), (d(1, 3),)]
    assert rows(rates.payment_months(raw, repair_feb29=True)) == [(d(1),), (d(1, 2),), (d(1, 3),)]
    assert rates.quote_days(months).count() == 62
    assert rates.quote_days(months, start=d(30)).count() == 2 + 31
    assert rates.quote_days(months, d(30), d(2, 3)).count() == 2 + 2
    assert rates.quote_days(months, d(2, 3), d(30)).count() == 0
    none = rates.payment_months(table(spark, "data_pagamento", ("x",)))
    assert rates.quote_days(none).count() == 0
    assert rates.quote_days(none, d(30), d(2, 2)).count() == 4


def test_currencies_of_countries(spark):
    countries = spark.createDataFrame([("BRASIL",), ("PORTUGAL",), ("FRANCA",), ("CHILE",), ("CANADA",)], "p string")
    assert rows(rates.currencies_of_countries(countries, "p")) == [("CAD",), ("EUR",)]


def test_filled_grid_has_no_gap_after_the_first_quote(spark):
    rng = np.random.default_rng(2)
    days = pd.date_range("2024-01-01", periods=200)
    known = pd.DataFrame({"data": rng.choice(days, 30, replace=False), "moeda": "USD", "cotacao_compra": 1.0})
    known["cotacao_venda"] = rng.random(30)
    q = spark.createDataFrame(known).withColumn("data", F.to_date("data"))
    full = rates.complete_quotes(q, spark.createDataFrame([(x.date(),) for x in days], "data date"), ["USD"]).toPandas()
    expected = known.set_index("data").cotacao_venda.reindex(days).ffill().dropna()
    got = full.set_index("data").cotacao_venda.sort_index()
    assert np.allclose(got.to_numpy(), expected.to_numpy())


# --- star -----------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def built(spark, clients, sell_rates):
    categories = silver.clean_categories(table(
        spark, "codigo_categoria nome_categoria tipo_categoria", ("c2", "dois", "r"), ("c1", "um", "d")))
    targets = silver.clean_targets(table(spark, "mes_meta meta", ("02/2025", "7k"), ("01/2025", "8k"), ("x", "1k")))
    receivables = silver.clean_receivables(table(
        spark, LEDGER,
        ("1", "t", "1", " c1 ", "100", "2025-01-10", "2025-01-09"), ("1", "t", "1", "c1", "300", "2025-01-10", ""),
        ("2", "t", "2", "zz", "10", "2025-01-12", "2025-01-03"), ("3", "t", "99", "c2", "5", "", "")),
        clients, sell_rates)
    payables = silver.clean_payables(table(
        spark, LEDGER.replace("id_cliente", "destino_pagamento_conta") + " status_conta",
        ("7", "t", "x", "c2", "1", "2025-01-09", "2025-03-01", "Pago")))
    return star.build_star(clients, categories, targets, payables, receivables)


def test_dimensions(built):
    assert [r[0] for r in rows(built.dim_cliente, "id_cliente")] == [1, 2, 3, 4]
    assert rows(built.dim_cliente, "id_cliente")[1][1] == "Bo"
    assert rows(built.dim_categoria) == [(1, "c1", "UM", "D"), (2, "c2", "DOIS", "R")]
    # The second arrival of client 2 lives in Canada; its currency is one of the clients' currencies.
    assert rows(built.dim_moeda) == [(1, "ARS"), (2, "BRL"), (3, "CAD"), (4, "USD")]
    days = [r.data_calendario for r in built.dim_data.orderBy("sk_data").collect()]
    assert days == [d(1), d(3), d(9), d(10), d(12), d(1, 2), d(1, 3)]


def test_facts(built):
    got = rows(built.fato_conta_receber.select(
        "id_conta_receber", "id_cliente", "sk_categoria", "sk_moeda", "sk_data_pagamento", "sk_data_vencimento",
        "valor_conta", "valor_conta_brl"), "id_conta_receber")
    assert got == [(1, 1, 1, 2, None, 4, 300.0, 300.0), (2, 2, None, 4, 2, 5, 10.0, 51.0),
                   (3, 99, 2, 2, None, None, 5.0, 5.0)]
    assert rows(built.fato_conta_pagar) == [(7, 2, 2, 7, 3, 1.0, 1.0, "Pago", "x", None)]
    assert rows(built.fato_meta_mensal) == [
        (1, 6, 7000.0, 2, 2025, "fevereiro"), (2, 1, 8000.0, 1, 2025, "janeiro"), (3, None, 1000.0, None, None, None)]


def test_roll_up(built):
    got = star.roll_up(built.fato_conta_receber, [(built.dim_moeda, "sk_moeda", "sk_moeda")], ["codigo_moeda"],
                       "valor_conta_brl")
    assert rows(got) == [("BRL", 305.0, 2), ("USD", 51.0, 1)]


# --- customers ------------------------------------------------------------------------------------------------------

def _receivables(spark, *values):
    schema = ("id_conta long, id_cliente long, valor_conta_brl double, data_vencimento date, data_pagamento date, "
              "status_conta string, codigo_categoria string")
    return spark.createDataFrame([(i, *v) for i, v in enumerate(values)], schema)


def _clients(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}", None, None, None) for i in ids],
                                 "id_cliente long, nome_cliente string, pais_cliente string, moeda_pais string, "
                                 "data_cadastro_cliente date")


@pytest.fixture(scope="module")
def features(spark):
    receivables = _receivables(
        spark, (1, 100.0, d(10), d(9), "b", "c1"), (1, 200.0, d(10), d(15), "a ", "c1"),
        (1, 300.0, d(20), None, None, "c2"), (3, 50.0, d(10), None, None, "zz"))
    categories = spark.createDataFrame([("c1", "UM / x"), ("c2", "um x"), ("c3", "TRES")],
                                       "codigo_categoria string, nome_categoria string")
    return customers.client_features(_clients(spark, 1, 2, 3), receivables, categories)


def test_client_features(features):
    columns = ["frequencia_recebimentos", "valor_total_recebido_brl", "valor_medio_recebido_brl", "recencia_dias",
               "media_dias_atraso", "variancia_dias_atraso", "desvio_dias_atraso", "taxa_pagamento_em_dia",
               "taxa_pagamento_atrasado", "mix_cat_um_x", "mix_cat_sem_categoria"]
    got = {r.id_cliente: [r[c] for c in columns] for r in features.collect()}
    assert got[1] == pytest.approx([3, 600, 200, 0, 4 / 3, 31 / 3, (31 / 3) ** 0.5, 2 / 3, 1 / 3, 1, 0])
    assert got[2] == [0] * len(columns)
    assert got[3] == pytest.approx([1, 50, 50, 9999, 0, 0, 0, 1, 0, 0, 1])
    texts = {r.id_cliente: (r.faixa_valor_cliente, r.status_mais_comum, r.pais_cliente, r.moeda_pais)
             for r in features.collect()}
    unknown = ("DESCONHECIDO", "DESCONHECIDA")
    assert texts == {1: ("muito_alto_valor", "a", *unknown), 2: ("medio_baixo_valor", "sem_status", *unknown),
                     3: ("alto_valor", "sem_status", *unknown)}
    logs = {r.id_cliente: r.valor_total_recebido_brl_log1p for r in features.collect()}
    assert logs == pytest.approx({1: np.log1p(600), 2: 0, 3: np.log1p(50)})


def test_profile_label(features):
    got = {r.id_cliente: r.p for r in features.select("id_cliente", customers.profile_label().alias("p")).collect()}
    assert got[1] == "recente|baixa_frequencia|muito_alto_valor|atrasa_pagamento"
    assert got[3] == "inativo|baixa_frequencia|alto_valor|bom_pagador"


def test_most_common_status_breaks_ties_by_text(spark):
    df = _receivables(spark, *[(1, 1.0, d(1), d(1), s, "c") for s in ("b", "a", "b ", "a", None, None, None)])
    assert customers.client_rfm(customers.client_totals(df)).first().status_mais_comum == "a"


def test_nobody_paid_yet(spark):
    df = _receivables(spark, (1, 1.0, d(1), None, "b", "c"))
    assert customers.client_rfm(customers.client_totals(df)).first().recencia_dias == 9999


def test_mix_shares_add_up(spark):
    rng = np.random.default_rng(1)
    df = _receivables(spark, *[(int(c), 1.0, d(1), d(2), "s", f"k{k}") for c, k in rng.integers(0, 9, (400, 2))])
    mix = customers.category_mix(df)
    sums = [r[1] for r in mix.groupBy("id_cliente").agg(F.sum("parcela")).collect()]
    assert sums == pytest.approx([1.0] * 9)
    wide = customers.mix_columns(mix).toPandas()
    assert list(wide.columns[1:]) == [*(f"mix_cat_k{i}" for i in range(9)), "mix_resto"]
    assert np.allclose(wide.iloc[:, 1:].sum(axis=1), 1) and (wide.mix_resto == 0).all()
    few = customers.mix_columns(mix, ["k3"]).toPandas()
    assert list(few.columns[1:]) == ["mix_cat_k3", "mix_resto"]
    assert np.allclose(few.iloc[:, 1:].sum(axis=1), 1) and few.mix_resto.max() > 0.5
    assert customers.common_categories(mix, 2) == sorted(customers.common_categories(mix, 2)) != []


def test_sums_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    amounts = spark.createDataFrame([(float(x),) for x in rng.uniform(0, 1e9, 20_000)], "v double")
    total = lambda n: amounts.repartition(n).agg(stable_sum(exact(F.col("v")))).first()[0]
    assert total(1) == total(7) == total(64) > 9e12


@pytest.mark.parametrize("values", [
    [1, 2, 3], [0, 0, 0, 1, 2], [5, 5, 5], [0, 0, 0, 0, 1, 2, 3, 9, 9], list(range(30)), [7],
])
def test_value_bands_follow_percentile_rank(spark, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id_cliente int, v double")
    got = {r.id_cliente: r.faixa_valor_cliente for r in customers.with_value_band(df, "v").collect()}
    rank3 = pd.Series(values).rank(method="average") * 3
    n = len(values)
    expected = ["muito_alto_valor" if r > 2 * n else "alto_valor" if r > n else "medio_baixo_valor" for r in rank3]
    assert [got[i] for i in range(n)] == expected
    ranks = {r.id_cliente: r.rank_pct for r in customers.percentile_ranks(df, "v").collect()}
    assert [ranks[i] for i in range(n)] == pytest.approx(list(rank3 / 3 / n))


# --- reports --------------------------------------------------------------------------------------------------------

def test_reports(spark):
    pdf = pd.DataFrame({"id": range(12), "pais": list("aabbbbccccc") + [None], "cluster": [0, 1] * 6,
                        "faixa": ["x", "y", "x"] * 4, "v": np.arange(12.0) ** 2})
    df = spark.createDataFrame(pdf)
    assert rows(reports.value_counts(df, "pais"))[0] == ("a", 2, 18.2)
    cross = reports.crosstab(df, "pais", "cluster", ["0", "1"]).toPandas().set_index("pais")
    expected = pd.crosstab(pdf.pais, pdf.cluster, margins=True)
    assert (cross.Outros == 0).all()
    assert (cross.drop(columns="Outros").to_numpy() == expected.to_numpy()).all() and list(cross.index) == ["a", "b", "c", "All"]
    part = reports.crosstab(df, "pais", "cluster", [0]).toPandas().set_index("pais")
    assert (part["0"] + part.Outros == part.All).all() and part.Outros.sum() > 0
    stats = reports.band_statistics(df, "faixa", "v").toPandas().set_index("faixa").sort_index()
    wanted = pdf.groupby("faixa").v.agg(["count", "mean", "median", "min", "max"])
    assert np.allclose(stats.to_numpy(float), wanted.to_numpy(float))
    cut = reports.tercile_cutoffs(df, "v").first()
    assert tuple(cut) == pytest.approx((pdf.v.quantile(1 / 3), pdf.v.quantile(2 / 3)))
    five = reports.five_numbers(df, ["v"]).toPandas().set_index("cluster").sort_index()
    wanted = pdf.groupby("cluster").v.quantile([0, 0.25, 0.5, 0.75, 1]).unstack()
    assert np.allclose(five.iloc[:, 1:].to_numpy(float), wanted.to_numpy())
    assert reports.distinct_values(df, "pais").count() == 4
    assert [r.id for r in reports.first_rows(df, ["id"], 3).collect()] == [0, 1, 2]


# --- segments -------------------------------------------------------------------------------------------------------

def _metrics(spark, *values):
    return spark.createDataFrame([(n, 2, 0.0, s, b, c) for n, s, b, c in values], MODEL_METRICS)


def test_model_ranking(spark):
    ranked = segments.rank_models(_metrics(spark, ("b", 0.5, 2.0, 200.0), ("a", 0.5, 1.0, 100.0), ("c", 0.1, 3.0, 50.0)))
    got = [(r.model_name, r.rank_silhouette, r.rank_davies_bouldin, r.rank_calinski_harabasz, r.ranking_score)
           for r in segments.top_models(ranked).collect()]
    assert [g[0] for g in got] == ["a", "b", "c"]
    assert [g[1:4] for g in got] == [(1.5, 1, 2), (1.5, 2, 1), (3, 3, 3)]
    assert [g[4] for g in got] == pytest.approx([1 / 4.5, 1 / 4.5, 1 / 9])
    assert segments.top_models(ranked, 1).first().model_name == "a"


def test_metrics_follow_their_formulas(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 1, (20, 3)) for c in (0, 4, 9)])
    y = np.repeat([0, 1, 2], 20)
    df = spark.createDataFrame([(int(k), Vectors.dense(v)) for k, v in zip(y, x)], ["cluster", "features"])
    got = segments.labelling_metrics(df.withColumn("cluster", F.col("cluster").cast("int")), "m")

    centres = np.array([x[y == k].mean(0) for k in range(3)])
    within = sum(((x[y == k] - centres[k]) ** 2).sum() for k in range(3))
    between = sum(20 * ((centres[k] - x.mean(0)) ** 2).sum() for k in range(3))
    spread = [np.linalg.norm(x[y == k] - centres[k], axis=1).mean() for k in range(3)]
    davies = np.mean([max((spread[i] + spread[j]) / np.linalg.norm(centres[i] - centres[j])
                          for j in range(3) if j != i) for i in range(3)])
    squared = ((x[:, None] - x[None]) ** 2).sum(2)
    scores = []
    for i in range(60):
        inside = squared[i, y == y[i]].sum() / 19
        outside = min(squared[i, y == k].mean() for k in range(3) if k != y[i])
        scores.append((outside - inside) / max(inside, outside))
    assert got["n_clusters"] == 3 and got["noise_ratio"] == 0
    assert got["davies_bouldin"] == pytest.approx(davies)
    assert got["calinski_harabasz"] == pytest.approx(between / 2 / (within / 57))
    assert got["silhouette"] == pytest.approx(np.mean(scores))


def test_degenerate_labelling(spark):
    df = spark.createDataFrame(
        [(0, Vectors.dense([1.0])), (0, Vectors.dense([2.0])), (-1, Vectors.dense([9.0]))], ["cluster", "features"])
    got = segments.labelling_metrics(df.withColumn("cluster", F.col("cluster").cast("int")), "m")
    assert got == {"model_name": "m", "n_clusters": 1, "noise_ratio": pytest.approx(1 / 3), "silhouette": -1.0,
                   "davies_bouldin": 999999.0, "calinski_harabasz": 0.0}


@pytest.fixture(scope="module")
def grouped_features(spark):
    rng = np.random.default_rng(8)
    groups = np.repeat([0, 1, 2], 15)
    pdf = pd.DataFrame({
        "id_cliente": range(45), "nome_cliente": "n", "pais_cliente": np.where(groups == 0, "BRASIL", "CHILE"),
        "moeda_pais": "BRL", "recencia_dias": groups * 100 + rng.random(45), "frequencia_recebimentos": groups * 9,
        "valor_total_recebido_brl": groups * 50.0 + rng.random(45), "faixa_valor_cliente": "alto_valor",
        "taxa_pagamento_em_dia": 1.0, "taxa_pagamento_atrasado": 0.0, "constante": 3.0,
    })
    return spark.createDataFrame(pdf)


def test_feature_vectors(grouped_features):
    found = segments.feature_vectors(grouped_features)
    vectors = np.array([r.features.toArray() for r in found.select("id_cliente", segments.dense(found.features).alias("features"))
                       .orderBy("id_cliente").collect()])
    # Six numbers, then BRASIL and CHILE, one currency, one band.
    assert vectors.shape == (45, 6 + 2 + 1 + 1)
    assert np.allclose(vectors[:, :3].mean(0), 0) and np.allclose(vectors[:, :3].std(0), 1)
    assert np.allclose(vectors[:, 5], 0)
    assert np.allclose(vectors[:, 6:8].sum(1), 1) and np.allclose(vectors[:, 8:], 1)


def test_cluster_counts_beyond_the_clients_are_listed(spark, grouped_features):
    few = grouped_features.where("id_cliente in (0, 20, 40)")
    chosen = segments.compare_clusterings(few, counts=[2, 5], restarts=1)
    rows_of = {r.model_name: r for r in chosen.comparison.collect()}
    assert sorted(rows_of) == ["agglomerative_k2", "agglomerative_k5", "kmeans_k2", "kmeans_k5"]
    assert rows_of["kmeans_k5"].silhouette == -1 and chosen.winner.endswith("k2")
    assert segments.compare_clusterings(few.limit(1), counts=[2], restarts=1).labels.count() == 1
    assert segments.compare_clusterings(few.where("false"), counts=[2], restarts=1).labels.count() == 0


def test_choice_among_models(spark, grouped_features):
    chosen = segments.compare_clusterings(grouped_features, counts=[2, 3], restarts=3)
    assert sorted(r.model_name for r in chosen.comparison.collect()) == [
        "agglomerative_k2", "agglomerative_k3", "kmeans_k2", "kmeans_k3"]
    assert chosen.winner.endswith("k3")
    out = segments.segment_output(grouped_features, chosen.labels, chosen.winner).toPandas().sort_values("id_cliente")
    assert out.groupby(np.repeat([0, 1, 2], 15)).cluster.nunique().tolist() == [1, 1, 1]
    assert set(out.modelo_vencedor) == {chosen.winner}
    placed, explained = segments.project_2d(chosen.vectors, chosen.labels)
    assert placed.count() == 45 and 0.5 < sum(explained) <= 1.0001
    assert reports.centroids(placed, ["pc1", "pc2"]).count() == 3
    profile = reports.segment_profile(segments.segment_output(grouped_features, chosen.labels, "m")).toPandas()
    assert profile.clientes.tolist() == [15, 15, 15] and set(profile.pct_alto_valor) == {100.0}


def test_crosstab_of_values_named_as_its_labels(spark):
    df = spark.createDataFrame([("x", "a"), ("x", "All"), ("All", "Outros"), ("All", "a"), (None, "a")], "r string, c string")
    table = reports.crosstab(df, "r", "c", ["a", "b"])
    assert table.columns == ["r", "a", "b", "Outros", "All"]
    assert [tuple(r) for r in table.collect()] == [("All", 1, 0, 1, 2), ("x", 1, 0, 1, 2), ("All", 2, 0, 2, 4)]
    with pytest.raises(ValueError, match="other labels"):
        reports.crosstab(df, "r", "c", ["a", "All"])

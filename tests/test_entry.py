import os
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as driver
from ledgermill.testbed import oracle, queries

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SMALL):
        connection.execute(f"create view {name.split('.')[0]} as select * from '{SMALL}/{name}'")
    return connection


def plain(value):
    if isinstance(value, (datetime, date)):
        return value.isoformat()[:10]
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


def multiset(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(row[i]) for i in order) for row in data), key=repr)


def test_every_twin_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(queries.queries()) - set(oracle.oracle_sql()) == {"cluster_model_comparison", "cluster_pca"}


@pytest.mark.parametrize("name", [
    "clean_targets", "clean_categories", "clean_clients", "bronze_date_parse", "complete_quotes", "dim_date",
    "new_keys_only", "new_part_keys_hot", "hot_client_currency", "append_star_twice", "landed_clients_csv", "landed_clients_json",
    "landed_quotes", "silver_layer_by_month", "segment_quality", "feature_vector_entries", "pca_of_two", "forced_clusters",
    "forced_candidates", "feature_levels", "pca_of_blocks", "feature_mix_entries", "append_layer_twice", "replaced_months", "landed_folder",
    "sorted_layer_order", "first_clients", "payable_quantiles_by_load", "segment_five_numbers_by_sketch",
    "split_lines_csv", "split_orders_json", "silver_quality_log",
    "client_category_mix_wide", "quality_keys", "country_segment_crosstab", "quality_ledgers", "client_features", "revenue_by_month_currency_category",
])
def test_queries_agree_with_sql(spark, duck, name):
    df = driver.queries()[name](spark, SMALL)
    got = multiset(df.columns, df.collect())
    result = duck.execute(driver.oracle_sql()[name])
    assert got == multiset([c[0] for c in result.description], result.fetchall())


def test_entry(spark):
    assert driver.entry(spark).columns == ["ano", "mes", "codigo_moeda", "tipo_categoria", "valor_conta_brl_total",
                                           "lancamentos"]

"""The JVM does not compile methods of more than 8,000 bytes; a row that passes through one costs several times as much."""

import re
from datetime import datetime

import pytest

from ledgermill.plans import silver
from ledgermill.testbed.tables import Tables


@pytest.fixture()
def tables(spark, tmp_path):
    day = datetime(1996, 2, 28)
    rows = {
        "customer": ([(1, "Customer#1", 3)], "c_custkey bigint, c_name string, c_nationkey int"),
        "part": ([(1, "cold bolt", "Brand#1", "STEEL")], "p_partkey bigint, p_name string, p_brand string, p_type string"),
        "orders": ([(1, 1, day)], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp"),
        "lineitem": ([(1, 1, 1, 1, 10.0, "R", "O", day)], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                     "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return Tables(spark, str(tmp_path))


def _longest(spark, df, capsys) -> int:
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.select("*").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)))


def test_feeds_of_ledgers_compile(spark, tables, capsys):
    assert _longest(spark, tables.payables(), capsys) < 8000
    assert _longest(spark, tables.receivables(), capsys) < 8000


def test_cleanings_compile(spark, tables, tmp_path, capsys):
    for name, clean in (("payables", silver.clean_payables), ("receivables", silver.clean_receivables), ("clients", silver.clean_clients)):
        getattr(tables, name)().write.parquet(f"{tmp_path}/{name}")
        assert _longest(spark, clean(spark.read.parquet(f"{tmp_path}/{name}")), capsys) < 8000


def test_clients_of_one_split_are_shared_out(spark, tables):
    assert tables.clients().rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism

"""What the registered queries read and write on the way: feeds that one step reads are not landed, small tables are written first."""

import contextlib
import io
from datetime import datetime, timedelta

import pytest

from ledgermill.plans import rates
from ledgermill.testbed.queries import JOBS, Ledger


@pytest.fixture()
def ledger(spark, tmp_path):
    day = datetime(1996, 2, 28)
    rows = {
        "customer": ([(i, f"Customer#{i}", i % 13) for i in range(1, 9)], "c_custkey bigint, c_name string, c_nationkey int"),
        "part": ([(i, "cold bolt", f"Brand#{i}", "STEEL") for i in range(1, 4)],
                 "p_partkey bigint, p_name string, p_brand string, p_type string"),
        "orders": ([(i, 1 + i % 8, day) for i in range(1, 30)], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp"),
        "lineitem": ([(i, 1 + i % 3, 1, n, 10.0 * i, "R", "F", day + timedelta(days=i)) for i in range(1, 30) for n in (1, 2)],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, "
                     "l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "events": ([(i, i % 4, day, 2.0 + i) for i in range(1, 200)], "event_id bigint, user_id bigint, ts timestamp, value double"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return Ledger(spark, str(tmp_path))


def _plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.mark.parametrize("name", ["currency_counts", "feature_mix_entries", "fact_target", "fact_payable", "revenue_by_client_year"])
def test_feeds_read_once_are_not_landed(ledger, name):
    JOBS[name](ledger).count()
    assert not {"landed_receivables", "landed_payables"} & set(vars(ledger))


def test_receivables_are_not_shuffled_for_rates(ledger):
    plan = _plan(ledger.clean_receivables())
    assert "BroadcastHashJoin [moeda_pais" in plan and "hashpartitioning(moeda_pais" not in plan


def test_mix_needs_no_rates(ledger):
    JOBS["client_category_mix"](ledger).count()
    assert not {"written_rates", "silver_clients"} & set(vars(ledger))


def test_quotes_of_one_file_are_shared_out(ledger):
    assert ledger.quotes().rdd.getNumPartitions() >= ledger.spark.sparkContext.defaultParallelism


def test_payment_months_parse_every_text_once(spark):
    texts = ["01/02/1996", "1996-02-29", "03-31-1996", "29/02/1997", "nan", None, " 1996-02-01 "]
    raw = spark.createDataFrame([(t,) for t in texts * 3], "data_pagamento string")
    assert [str(r[0]) for r in rates.payment_months(raw).orderBy("mes").collect()] == ["1996-02-01", "1996-03-01"]
    lines = _plan(rates.payment_months(raw)).splitlines()
    parsed = max(i for i, line in enumerate(lines) if "cast(" in line and "as date" in line)
    assert any("HashAggregate(keys=[data_pagamento" in line for line in lines[parsed:])

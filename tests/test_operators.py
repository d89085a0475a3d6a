import random
from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgermill.operators import append, calendar, checks, dedup, headers, lookups, ordering

from .conftest import rows


def test_headers(spark):
    df = spark.createDataFrame([(1, "a")], " Id  int, NOME string".replace(" Id ", "`  Id `"))
    df = headers.tidy_headers(df)
    assert df.columns == ["id", "nome"]
    with pytest.raises(ValueError, match="x"):
        headers.require_columns(df, ["id", "x"])
    assert headers.with_optional(df, "y", "z", "nome").first().y == "a"
    assert headers.with_optional(df, "y").first().y is None


def test_survivor_prefers_name_then_type_then_arrival(spark):
    df = spark.createDataFrame([
        ("a", None, "r", 1), ("a", "n", "r", 4), ("b", "n", None, 3), ("b", "n2", "t", 5), ("b", "n3", "t", 6),
        ("c", None, None, 8), ("c", None, None, 7),
    ], f"k string, n string, t string, {dedup.ORDINAL} int")
    assert rows(dedup.best_labelled(df, "k", ["n", "t"])) == [
        ("a", "n", "r", 4), ("b", "n2", "t", 5), ("c", None, None, 7)]
    assert [r[3] for r in rows(dedup.first_arrived(df, ["k"]), "k")] == [1, 3, 7]
    assert [r[3] for r in rows(dedup.last_arrived(df, ["k"]), "k")] == [4, 6, 8]


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias(dedup.ORDINAL))
    plan = dedup.last_arrived(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    limit, exchange = plan.rfind("WindowGroupLimit"), plan.find("Exchange hashpartitioning")
    assert "Partial" in plan and 0 < exchange < limit


def _skewed_facts(spark):
    """A third of the rows share one key, another third has none."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 500)
        .cast("long").alias("k"), F.col("id").alias("v"),
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain_join(spark, how, null_safe):
    facts = _skewed_facts(spark)
    lookup = spark.createDataFrame([(i, f"n{i}") for i in range(0, 400)] + [(None, "nothing")], "k long, n string")
    salted = lookups.salted_join(facts, lookup, ["k"], how, null_safe=null_safe, parts=50)
    left, right = facts.toPandas(), lookup.toPandas()
    # pandas matches null keys to each other, as the null-safe join does.
    merged = left.merge(right if null_safe else right[right.k.notna()], on="k", how="left")
    found = merged.n.notna()
    expected = {"left": merged, "inner": merged[found], "left_anti": merged[~found], "left_semi": merged[found]}[how]
    got = salted.toPandas()
    assert len(got) == len(expected)
    assert got.v.sum() == expected.v.sum()
    if "n" in got:
        assert got.n.fillna("").value_counts().to_dict() == expected.n.fillna("").value_counts().to_dict()


def test_salting_spreads_the_hot_key(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "50",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        lookup = spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("n"))
        joined = lookups.salted_join(_skewed_facts(spark), lookup, ["k"], parts=50)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 30_000
    assert max(sizes) < 5_000  # unsalted, one task would hold a third or more


def test_lookup_join_leaves_the_choice_to_the_planner(spark):
    facts, lookup = spark.range(100).toDF("k"), spark.range(50).select(F.col("id").alias("k"), F.lit("x").alias("n"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    small = lookups.lookup_join(facts, lookup, ["k"])
    assert "Broadcast" in plan(small)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = lookups.lookup_join(facts, lookup, ["k"])
        assert "Broadcast" not in plan(large)
        assert rows(small) == rows(large) == rows(lookups.lookup_join(facts, lookup, ["k"], split_hot=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_new_keys_only(spark):
    incoming = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, v string")
    existing = spark.createDataFrame([(1,), (None,), (1,)], "k int")
    assert rows(append.new_keys_only(incoming, existing, ["k"])) == [(2, "b"), (2, "c")]
    again = append.new_keys_only(incoming, incoming.select("k"), ["k"])
    assert rows(again) == []


@pytest.fixture(params=["true", "false"])
def joined_ranges(spark, request):
    """Small ranges joined by the planner, and left apart."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, request.param)
    yield
    spark.conf.set(setting, "true")


def test_dense_key_follows_the_order(spark, joined_ranges):
    source = random.Random(3)
    names = [f"c{source.random():.9f}{i}" for i in range(5000)]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "n string").repartition(7)
    keyed = rows(ordering.dense_key(df, "sk", ["n"]), "sk")
    assert keyed == list(enumerate(sorted(names), start=1))


def test_keys_go_on_from_an_earlier_load(spark):
    first = ordering.dense_key(spark.createDataFrame([("b",), ("d",)], "n string"), "sk", ["n"])
    whole = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("d", 4), ("c", 5)], "n string, v int")
    again = ordering.continued_key(whole, "sk", ["n"], ["n"], first)
    assert rows(again.select("n", "sk", "v"), "sk") == [("b", 1, 2), ("d", 2, 4), (None, 3, 3), ("a", 4, 1), ("c", 5, 5)]
    assert rows(ordering.continued_key(whole, "sk", ["n"], ["n"], again).select("n", "sk"), "sk") == rows(again.select("n", "sk"), "sk")


def test_dense_key_of_nothing(spark):
    assert rows(ordering.dense_key(spark.createDataFrame([], "n string"), "sk", ["n"])) == []


@pytest.fixture(scope="module")
def measures():
    rng = np.random.default_rng(5)
    values = np.concatenate([np.zeros(400), rng.integers(0, 50, 300) / 2, rng.normal(100, 30, 500)])
    return pd.DataFrame({"g": rng.integers(0, 3, len(values)), "v": values})


def test_positions_give_average_ranks(spark, measures, joined_ranges):
    df = spark.createDataFrame(measures)
    ranks = ordering.value_positions(df, "v").select("v", ordering.average_rank().alias("r")).toPandas()
    expected = measures.v.rank(method="average")
    got = measures.v.map(ranks.set_index("v").r)
    assert np.allclose(got, expected)


@pytest.mark.parametrize("share", [0.0, 0.25, 1 / 3, 0.5, 2 / 3, 1.0])
def test_positions_give_exact_quantiles(spark, measures, joined_ranges, share):
    positions = ordering.value_positions(spark.createDataFrame(measures), "v", ["g"])
    got = positions.groupBy("g").agg(ordering.quantile("v", share).alias("q")).toPandas().set_index("g").q.sort_index()
    assert np.allclose(got, measures.groupby("g").v.quantile(share))


def test_islands(spark):
    df = spark.createDataFrame([(date(2025, 1, d),) for d in (4, 1, 2, 2)] + [(None,)], "d date")
    assert rows(calendar.contiguous_ranges(df, "d"), "inicio") == [
        (date(2025, 1, 1), date(2025, 1, 2)), (date(2025, 1, 4), date(2025, 1, 4))]


def test_spines(spark):
    assert calendar.daily_range(spark, date(2024, 2, 28), date(2024, 3, 1)).count() == 3
    assert calendar.daily_range(spark, date(2024, 3, 2), date(2024, 3, 1)).count() == 0
    months = spark.createDataFrame([(date(2024, 2, 1),), (date(2024, 4, 1),), (None,)], "m date")
    assert calendar.days_of_months(months, "m").count() == 29 + 30
    assert calendar.days_of_months(months, "m", date(2024, 2, 20), date(2024, 4, 5)).count() == 10 + 5
    assert calendar.days_of_months(months, "m", date(2024, 5, 1)).count() == 0


def test_fill_forward_fills_each_column_on_its_own(spark):
    df = spark.createDataFrame([("u", 1, None, 1.0), ("u", 2, 5.0, None), ("u", 3, None, 2.0), ("v", 1, None, None)],
                               "g string, t int, a double, b double")
    assert rows(calendar.fill_forward(df, "g", "t", ["a", "b"]), "g", "t") == [
        ("u", 1, None, 1.0), ("u", 2, 5.0, 1.0), ("u", 3, 5.0, 2.0), ("v", 1, None, None)]


def test_checks(spark):
    df = spark.createDataFrame([(1, "Pago "), (1, "em aberto"), (2, None), (None, "pendente")], "k int, s string")
    assert rows(checks.repeated_keys(df.where("k is not null"), ["k"])) == [(1, 2)]
    assert rows(checks.orphan_keys(df, "k", spark.createDataFrame([(1,)], "p int"), "p")) == [(2, 1)]
    assert tuple(df.agg(*checks.complete_rows(["k", "s"]), *checks.missing("k")).first()) == (2, 2, 1)
    counts = df.agg(F.count_if(checks.status_like("s", "recebido|pago")), F.count_if(checks.status_is("s", "pago")),
                    F.count_if(checks.status_like("s", "aberto|pendente"))).first()
    assert tuple(counts) == (1, 0, 2)
    assert rows(checks.column_profile(df)) == [("k", 3, "int"), ("s", 3, "string")]
    assert tuple(checks.before_and_after(df, df.dropna()).first()) == (4, 2, 2)


def test_counts_while_writing(spark, tmp_path):
    df, seen = checks.counted(spark.range(10), "rows", F.count_if(F.col("id") > 6).alias("large"))
    df.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"linhas": 10, "large": 3}


def test_key_rules_read_every_table_once(spark, tmp_path):
    facts = [(1, 10, "a"), (1, 10, "b"), (2, None, None), (3, 11, "b"), (None, 12, "z"), (None, 11, "y")]
    spark.createDataFrame(facts, "id bigint, d int, c string").write.parquet(str(tmp_path / "facts"))
    spark.createDataFrame([(10, "a"), (13, "b"), (13, None)], "d int, c string").write.parquet(str(tmp_path / "dim"))
    tables = {name: spark.read.parquet(str(tmp_path / name)) for name in ("facts", "dim")}
    unique = {"pk facts": ("facts", "id"), "pk dim": ("dim", "d"), "uk dim": ("dim", "c")}
    foreign = {"fk number": ("facts", "d", "dim", "d"), "fk text": ("facts", "c", "dim", "c")}
    found = checks.key_violations(tables, unique, foreign)
    # Ids 1 and null, dimension 13, numbers 11 and 12, texts z and y.
    assert dict(rows(found)) == {"pk facts": 2, "pk dim": 1, "uk dim": 0, "fk number": 2, "fk text": 2}
    assert found._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2
    for rule, (table, column) in unique.items():
        assert dict(rows(found))[rule] == checks.repeated_keys(tables[table], [column]).count()
    for rule, (table, column, dimension, primary) in foreign.items():
        assert dict(rows(found))[rule] == checks.orphan_keys(tables[table], column, tables[dimension], primary).count()
    nothing = {name: df.where("false") for name, df in tables.items()}
    assert set(dict(rows(checks.key_violations(nothing, unique, foreign))).values()) == {0}

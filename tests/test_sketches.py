import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgermill.operators import sketches
from ledgermill.sources.loads import LoadTable

from .conftest import rows

SHARES = [0.0, 0.25, 1 / 3, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def measures():
    rng = np.random.default_rng(3)
    values = np.concatenate([np.zeros(300), -rng.lognormal(2, 3, 400), rng.lognormal(4, 2, 900), rng.integers(1, 5, 300).astype(float)])
    return pd.DataFrame({"g": rng.choice(["a", "b", "c"], len(values)), "v": values, "load": rng.integers(0, 7, len(values))})


def test_buckets_follow_the_order_of_values(spark):
    values = sorted([-math.inf, -1e300, -2.5, -2.0, -5e-324, 0.0, 5e-324, 1e-9, 1.0, 1.019, 1.021, 7.0, 1e300, math.inf]) + [math.nan]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", sketches.bucket(F.col("v")).alias("b"))
    found = {repr(v): b for v, b in df.collect()}
    numbers = [found[repr(v)] for v in values]
    assert numbers == sorted(numbers) and found["0.0"] == 0 and found["1.019"] == found["1.021"] - 1


def test_buckets_are_as_narrow_as_the_accuracy(spark, measures):
    sketch = sketches.value_sketch(spark.createDataFrame(measures), "v", ["g"]).toPandas()
    width = (sketch.maior - sketch.menor).abs() / sketch[["menor", "maior"]].abs().min(axis=1).replace(0, 1)
    assert width.max() <= 2 * sketches.ACCURACY + 1e-9 and sketch.linhas.sum() == len(measures)


def test_one_load_and_seven_give_the_same_sketch(spark, measures, tmp_path):
    df = spark.createDataFrame(measures)
    table = LoadTable(spark, str(tmp_path), "valores")
    merged = sketches.sketch_loads(table, {str(i): df.where(F.col("load") == i) for i in range(7)}, "v", ["g"])
    assert rows(merged) == rows(sketches.value_sketch(df, "v", ["g"]))
    # Coarser groups come from the same rows.
    assert rows(sketches.merged(merged)) == rows(sketches.value_sketch(df, "v"))


def test_estimates_keep_their_bounds(spark, measures):
    df = spark.createDataFrame(measures)
    found = sketches.estimated_quantiles(sketches.value_sketch(df, "v", ["g"]), SHARES, ["g"]).toPandas()
    assert len(found) == 3 * len(SHARES)
    for row in found.itertuples():
        values = measures.v[measures.g == row.g].sort_values().to_numpy()
        place = (len(values) - 1) * row.parte
        size = max(abs(values[math.floor(place)]), abs(values[math.ceil(place)]))
        exact = np.quantile(values, row.parte)
        assert row.total == len(values) and row.minimo - 1e-9 <= exact <= row.maximo + 1e-9
        assert abs(row.estimativa - exact) <= sketches.ACCURACY * size + 1e-9


@pytest.mark.parametrize("by", [[], ["g"]])
def test_exact_quantiles_equal_a_full_sort(spark, measures, by):
    df = spark.createDataFrame(measures)
    found = sketches.exact_quantiles(df, "v", SHARES, sketches.value_sketch(df, "v", by), by)
    for row in found.collect():
        values = measures.v[measures.g == row["g"]] if by else measures.v
        assert row["quantil"] == pytest.approx(np.quantile(values, row["parte"]), rel=1e-12, abs=1e-12)
    wide = sketches.quantile_columns(found, by, {0.0: "least", 1.0: "most"})
    assert rows(wide) == rows(df.groupBy(*by).agg(F.min("v"), F.max("v")))


def test_null_groups_null_values_and_values_without_end(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("", 5.0), ("x", None), ("y", math.inf), ("y", math.inf), ("y", -math.inf),
                                ("z", None), ("z", 4.0)], "g string, v double")
    sketch = sketches.value_sketch(df, "v", ["g"])
    exact = {row["g"]: row["quantil"] for row in sketches.exact_quantiles(df, "v", [0.5], sketch, ["g"]).collect()}
    assert exact == {None: 2.0, "": 5.0, "y": math.inf, "z": 4.0}
    assert {row["g"] for row in sketches.estimated_quantiles(sketch, [0.5], ["g"]).collect()} == set(exact)


def test_only_rows_around_the_places_are_ordered(spark, measures, monkeypatch):
    seen = []
    whole = sketches.value_positions

    def watched(df, *given):
        seen.append(df.count())
        return whole(df, *given)

    monkeypatch.setattr(sketches, "value_positions", watched)
    df = spark.createDataFrame(measures).where("v > 10")
    assert len(sketches.exact_quantiles(df, "v", [0.5], sketches.value_sketch(df, "v")).collect()) == 1
    assert seen[0] < df.count() / 20


def test_nothing_gives_nothing(spark):
    empty = spark.createDataFrame([], "g string, v double")
    sketch = sketches.value_sketch(empty, "v", ["g"])
    assert rows(sketch) == rows(sketches.estimated_quantiles(sketch, [0.5], ["g"])) == []
    assert rows(sketches.exact_quantiles(empty, "v", [0.5], sketch, ["g"])) == []


def test_a_part_that_is_corrected_counts_once(spark, tmp_path):
    def values(*numbers):
        return sketches.value_sketch(spark.createDataFrame([(float(n),) for n in numbers], "v double"), "v")

    table = LoadTable(spark, str(tmp_path), "valores")
    sketches.keep_sketch(table, values(1, 2, 3), "jan", "a")
    sketches.keep_sketch(table, values(100, 200), "fev", "b")
    assert not sketches.keep_sketch(table, values(7), "jan", "a")
    sketches.keep_sketch(table, values(5), "jan", "c")
    assert rows(sketches.kept_sketch(table).select("menor"), "menor") == [(5.0,), (100.0,), (200.0,)]
    # A part that has become empty leaves nothing behind.
    sketches.keep_sketch(table, values(), "fev", "d")
    assert rows(sketches.kept_sketch(table).select("menor"), "menor") == [(5.0,)]

"""Quantiles out of small tables that are counted load by load and merged.

A sketch holds, per group, how many values lie in each bucket and the smallest and largest of them. Borders of buckets
grow by a fixed ratio, so a sketch has at most some 150,000 rows per group however many values it stands for, and sketches of different loads have the same buckets: merging adds counts and takes extremes, in any order and with the same
result as one sketch of all rows. Buckets are ordered as their values are, so a sketch tells exactly which bucket holds a
place in the order; only where in the bucket is left open.
"""

from __future__ import annotations

from math import ceil, log1p

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.loads import LOAD, LoadTable
from .lookups import lookup_join
from .ordering import value_positions

# Largest relative error of an estimate.
ACCURACY = 0.01
BUCKET, ORIGIN = "balde", "origem"
_LARGEST = 1.7976931348623157e308
# Above the logarithm of any double, whatever its sign.
_LOGARITHMS = 746


def bucket(value: Column, accuracy: float = ACCURACY) -> Column:
    """Number of the bucket of a value. Greater values have equal or greater numbers; infinite values and NaN, which
    Spark takes for the greatest, share the outermost ones."""
    step = log1p(2 * accuracy)
    offset = ceil(_LOGARITHMS / step)
    size = F.least(F.abs(value), F.lit(_LARGEST))
    place = (F.ceil(F.ln(size) / step) + offset).cast("bigint")
    return F.when(value == 0, F.lit(0).cast("bigint")).when(value < 0, -place).otherwise(place)


def value_sketch(df: DataFrame, value: str, by: list[str] = [], accuracy: float = ACCURACY) -> DataFrame:
    """Sketch of the non-null values of each group: `balde`, `linhas`, `menor`, `maior`. Counted inside each partition
    before the shuffle, so a group with most of the rows is no burden."""
    number = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull()).select(*by, bucket(number, accuracy).alias(BUCKET), number.alias("__value"))
    return rows.groupBy(*by, BUCKET).agg(
        F.count(F.lit(1)).alias("linhas"), F.min("__value").alias("menor"), F.max("__value").alias("maior"))


def merged(sketches: DataFrame, by: list[str] = []) -> DataFrame:
    """One sketch out of the rows of several with the same accuracy; coarser groups than theirs may be asked for."""
    return sketches.groupBy(*by, BUCKET).agg(
        F.sum("linhas").alias("linhas"), F.min("menor").alias("menor"), F.max("maior").alias("maior"))


def keep_sketch(table: LoadTable, sketch: DataFrame, origin: str, load: str) -> bool:
    """Put the sketch of one part of the rows, such as a month, in place of the one the table has of that part.

    As with all loads, a broken one changes nothing and one that was run before is not run again.
    """
    return table.replace(sketch.withColumn(ORIGIN, F.lit(origin)), load, ORIGIN, [origin])


def kept_sketch(table: LoadTable, by: list[str] = []) -> DataFrame:
    """All parts of the table merged."""
    return merged(table.read().drop(LOAD, ORIGIN), by)


def _places(sketch: DataFrame, shares: list[float], by: list[str]) -> DataFrame:
    """For each group and share the two places whose values a quantile lies between, counted from zero: the bucket that
    holds each, and the place within it."""
    order = Window.partitionBy(*by)
    counted = sketch.select(
        *by, BUCKET, "linhas", "menor", "maior", F.sum("linhas").over(order).alias("total"),
        (F.sum("linhas").over(order.orderBy(BUCKET)) - F.col("linhas")).alias("__less"))
    share = F.explode(F.array(*[F.lit(float(s)) for s in shares]))
    exact = (F.col("total") - 1) * F.col("parte")
    side = F.explode(F.array(*[F.struct(F.lit(name).alias("lado"), place.cast("bigint").alias("lugar"))
                               for name, place in (("baixo", F.floor(exact)), ("alto", F.ceil(exact)))]))
    sides = counted.withColumn("parte", share).withColumn("__side", side).select("*", "__side.lado", "__side.lugar")
    here = (F.col("__less") <= F.col("lugar")) & (F.col("lugar") < F.col("__less") + F.col("linhas"))
    return sides.where(here).select(
        *by, "parte", "lado", BUCKET, (F.col("lugar") - F.col("__less")).alias("dentro"), "total", "menor", "maior",
        (exact - F.floor(exact)).alias("resto"))


def _between(low: Column, high: Column) -> Column:
    return F.when(low == high, low).otherwise(low + (high - low) * F.max("resto"))


def _at(side: str, column: Column) -> Column:
    return F.max(F.when(F.col("lado") == side, column))


def estimated_quantiles(sketch: DataFrame, shares: list[float], by: list[str] = []) -> DataFrame:
    """`total`, `estimativa`, `minimo` and `maximo` for each group and share in `parte`, from a sketch alone.

    The linearly interpolated quantile lies from `minimo` to `maximo`; the estimate is off by at most the sketch's
    accuracy times its two neighbours' size. No values give no rows.
    """
    middle = F.when(F.col("menor") == F.col("maior"), F.col("menor")).otherwise(F.col("menor") / 2 + F.col("maior") / 2)
    return _places(sketch, shares, by).groupBy(*by, "parte").agg(
        F.max("total").alias("total"),
        _between(_at("baixo", middle), _at("alto", middle)).alias("estimativa"),
        _between(_at("baixo", F.col("menor")), _at("alto", F.col("menor"))).alias("minimo"),
        _between(_at("baixo", F.col("maior")), _at("alto", F.col("maior"))).alias("maximo"))


def exact_quantiles(df: DataFrame, value: str, shares: list[float], sketch: DataFrame, by: list[str] = [],
                    accuracy: float = ACCURACY) -> DataFrame:
    """`quantil` for each group and share in `parte`: the linearly interpolated quantile, exactly.

    `sketch` must be that of `df`. Only rows in the few buckets that hold a place are shuffled and ordered; all others
    are passed over by the scan, so nothing of the size of the table is sorted.
    """
    places = _places(sketch, shares, by)
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__value"))
    rows = rows.withColumn(BUCKET, bucket(F.col("__value"), accuracy))
    rows = lookup_join(rows, places.select(*by, BUCKET).distinct(), [*by, BUCKET], "left_semi", null_safe=True)
    # Positions are joined by their groups, so null groups go under a text that no value has.
    keys = [f"__key_{i}" for i in range(len(by))]
    keyed = {key: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for key, c in zip(keys, by)}
    positions = value_positions(rows.withColumns(keyed).drop(*by), "__value", [*keys, BUCKET])
    wanted = places.withColumns(keyed)
    found = wanted.join(positions.drop("total"), [*keys, BUCKET]).where(
        (F.col("less") <= F.col("dentro")) & (F.col("dentro") < F.col("less") + F.col("eq")))
    return found.groupBy(*by, "parte").agg(_between(_at("baixo", F.col("__value")), _at("alto", F.col("__value"))).alias("quantil"))


def quantile_columns(quantiles: DataFrame, by: list[str], names: dict[float, str], value: str = "quantil") -> DataFrame:
    """One row per group with a column for each share."""
    columns = [F.max(F.when(F.col("parte") == float(share), F.col(value))).alias(name) for share, name in names.items()]
    return quantiles.groupBy(*by).agg(*columns)


def sketch_loads(table: LoadTable, parts: dict[str, DataFrame], value: str, by: list[str] = [],
                 accuracy: float = ACCURACY) -> DataFrame:
    """Keep the sketch of every part under its name and return all of them merged."""
    for origin, rows in parts.items():
        keep_sketch(table, value_sketch(rows, value, by, accuracy), origin, f"inicial-{origin}")
    return kept_sketch(table, by)

"""Counts that tell whether a table is sound."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip_column


def missing(*columns: str) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"sem_{c}") for c in columns]


def complete_rows(columns: list[str]) -> list[Column]:
    """Rows with all columns filled, and the others."""
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    return [F.count_if(~any_null).alias("validas"), F.count_if(any_null).alias("invalidas")]


def status_like(column: str, pattern: str) -> Column:
    """Does the status text contain the pattern, whatever its case?"""
    return F.coalesce(F.lower(strip_column(F.col(column))).rlike(pattern), F.lit(False))


def status_is(column: str, text: str) -> Column:
    return F.coalesce(F.lower(F.col(column)) == text, F.lit(False))


def before_and_after(before: DataFrame, after: DataFrame, *more: Column) -> DataFrame:
    """One row: rows before a cleaning, rows after, rows removed, and further counts over the cleaned rows."""
    rows = before.agg(F.count(F.lit(1)).alias("linhas_antes"))
    kept = after.agg(F.count(F.lit(1)).alias("linhas_depois"), *more)
    return kept.select(
        rows.scalar().alias("linhas_antes"), "linhas_depois",
        (rows.scalar() - F.col("linhas_depois")).alias("removidas"),
        *[c for c in kept.columns if c != "linhas_depois"],
    )


def counted(df: DataFrame, name: str, *counts: Column) -> tuple[DataFrame, Observation]:
    """Count rows while they pass, for jobs that write the table anyway; needs no pass of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("linhas"), *counts), seen


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas")).where("linhas > 1")


def orphan_keys(facts: DataFrame, foreign: str, dimension: DataFrame, primary: str) -> DataFrame:
    """Non-null foreign keys without a row in the dimension, with the number of facts that hold them.

    Facts are counted per key first, so the join sees each key once however many facts share it.
    """
    used = facts.where(F.col(foreign).isNotNull()).groupBy(foreign).agg(F.count(F.lit(1)).alias("linhas"))
    return used.join(dimension.select(F.col(primary).alias(foreign)), foreign, "left_anti")


def key_violations(tables: dict[str, DataFrame], unique: dict[str, tuple[str, str]],
                   foreign: dict[str, tuple[str, str, str, str]]) -> DataFrame:
    """For each rule the number of keys that break it, `regra` and `violacoes`; every table is read once for all its rules.

    `unique` names a table and its column, whose keys (nulls are one) may not be repeated; `foreign` a table and column, and the
    dimension and column that must hold its keys other than null. Keys may be numbers or text. Rows are counted per rule
    and key inside each partition before the one shuffle, so a hot key arrives as one row per partition. Empty tables
    break no rule.
    """
    uses: dict[str, list[Column]] = {name: [] for name in tables}

    def use(rule: str, table: str, column: str, counted: int, held: bool, null_too: bool) -> None:
        text = isinstance(tables[table].schema[column].dataType, T.StringType)
        key = F.struct(
            F.lit(rule).alias("regra"), (F.lit(None).cast("bigint") if text else F.col(column).cast("bigint")).alias("numero"),
            (F.col(column) if text else F.lit(None).cast("string")).alias("texto"), F.lit(counted).cast("bigint").alias("linhas"),
            F.lit(held).alias("presente"))
        uses[table].append(key if null_too else F.when(F.col(column).isNotNull(), key))

    for rule, (table, column) in unique.items():
        use(rule, table, column, 1, True, True)
    for rule, (table, column, dimension, primary) in foreign.items():
        use(rule, table, column, 1, False, False)
        use(rule, dimension, primary, 0, True, False)
    parts = [tables[name].select(F.explode(F.array(*keys)).alias("uso")).where("uso is not null").select("uso.*") for name, keys in uses.items() if keys]
    keys = reduce(DataFrame.unionAll, parts).groupBy("regra", "numero", "texto").agg(
        F.sum("linhas").alias("linhas"), F.max("presente").alias("presente"))
    broken = F.when(F.col("regra").isin(list(unique)), F.col("linhas") > 1).otherwise(~F.col("presente") & (F.col("linhas") > 0))
    found = keys.groupBy("regra").agg(F.count_if(broken).alias("violacoes"))
    rules = parts[0].sparkSession.range(1).select(F.explode(F.array(*[F.lit(rule) for rule in [*unique, *foreign]])).alias("regra"))
    return rules.join(found, "regra", "left").select("regra", F.coalesce("violacoes", F.lit(0)).cast("bigint").alias("violacoes"))


def column_profile(df: DataFrame) -> DataFrame:
    """Type and number of filled cells for each column, in one pass."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = filled.unpivot([], list(df.columns), "coluna", "preenchidas")
    kinds = F.create_map(*[F.lit(x) for item in types.items() for x in item])
    return long.withColumn("tipo", F.element_at(kinds, F.col("coluna")))

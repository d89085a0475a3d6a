"""Dirty ledger feeds derived from the driver's tables by projections.

The expressions are plain SQL that Spark and DuckDB read alike, so both sides of a comparison start from the same
text. Doubles may be written differently by the two; they are parsed back to the same number.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import ORDINAL
from ..sources.shared import spread


def _text(x: str) -> str:
    return f"cast({x} as string)"


def _pad(x: str, n: int = 2) -> str:
    return f"lpad({_text(x)}, {n}, '0')"


def _iso(d: str) -> str:
    return f"{_pad(f'year({d})', 4)} || '-' || {_pad(f'month({d})')} || '-' || {_pad(f'day({d})')}"


def _dmy(d: str) -> str:
    return f"{_text(f'day({d})')} || '/' || {_pad(f'month({d})')} || '/' || {_pad(f'year({d})', 4)}"


def _mdy(d: str) -> str:
    return f"{_pad(f'month({d})')} || '-' || {_pad(f'day({d})')} || '-' || {_pad(f'year({d})', 4)}"


def _choose(number: str, values: list[str]) -> str:
    cases = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    return f"case {number} {cases} end"


@dataclass
class Feed:
    """Columns of a feed over joined tables; `ordinal` fixes the order of arrival."""

    tables: str
    columns: dict[str, str]
    ordinal: list[str]

    def sql(self) -> str:
        columns = ", ".join(f"{e} as {c}" for c, e in self.columns.items())
        return f"select {columns}, row({', '.join(self.ordinal)}) as {ORDINAL} from {self.tables}"


_CLIENT = _text("c_custkey - (case when c_custkey % 50 = 49 then 1 else 0 end)")
_SIGNED = "(date '2023-01-01' + cast(c_custkey % 365 as int))"

CLIENTS = Feed(
    tables="customer",
    columns={
        "id_cliente": f"case when c_custkey % 97 = 5 then 'x' || {_CLIENT} when c_custkey % 4 = 1 then {_CLIENT} || '.0'"
                      f" when c_custkey % 4 = 2 then ' ' || {_CLIENT} || ' ' else {_CLIENT} end",
        "nome_cliente": "case when c_custkey % 31 = 7 then null else " + _choose("c_custkey % 5", [
            "' ' || lower(c_name) || ' '",
            f"upper('maria  da silva ' || {_CLIENT})",
            f"'JosÃ©  DE Souza ' || {_CLIENT}",
            "'JOÃO e ' || c_name",
            "c_name || ' dos Santos'",
        ]) + " end",
        "pais_cliente": _choose("c_nationkey % 13", [
            "'Brasil'", "' portugal '", "'FranÃ§a'", "'Estados Unidos'", "'CANADÃ\u0081'", "'Inglaterra '", "'uk'",
            "'USA '", "'Argentina'", "'Estados  Unidos da AmÃ©rica'", "'Chile'", "null", "'canadÃ'",
        ]),
        "data_cadastro_cliente": "case when c_custkey % 19 = 3 then '29/02/2023' when c_custkey % 23 = 4 then ''"
                                 " when c_custkey % 29 = 5 then '01-13-2023'"
                                 f" when c_custkey % 2 = 0 then {_iso(_SIGNED)} else {_dmy(_SIGNED)} end",
    },
    ordinal=["c_custkey"],
)

CATEGORIES = Feed(
    tables="part",
    columns={
        "codigo_categoria": "case when p_partkey % 41 = 0 then null when p_partkey % 3 = 0 then ' ' || p_brand || ' '"
                            " else p_brand end",
        "nome_categoria": "case p_partkey % 7 when 0 then null when 1 then upper(p_name) || ' '"
                          " when 2 then replace(p_name, 'e', 'é') when 3 then replace(p_name, ' ', '  / ')"
                          " else p_name end",
        "tipo_categoria": "case p_partkey % 6 when 0 then null when 1 then lower(p_type) else p_type end",
    },
    ordinal=["p_partkey"],
)

_ENTRY = "(l_orderkey * 10 + l_linenumber)"
_PAID = "cast(l_shipdate as date)"
_DUE = f"({_PAID} + (cast(l_partkey % 31 as int) - 10))"
_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]

_LEDGER = {
    "id_conta": f"case when {_ENTRY} % 389 = 0 then 'x' || {_text(_ENTRY)}"
                f" when {_ENTRY} % 11 = 3 then {_text(_ENTRY)} || '.0' else {_text(_ENTRY)} end",
    "descricao_conta": "'item ' || " + _text("l_linenumber"),
    "codigo_categoria": "case when l_partkey % 3 = 0 then ' ' || p_brand || ' ' else p_brand end",
    "valor_conta": f"case when l_partkey % 613 = 1 then 'abc' else {_text('l_extendedprice')} end",
    "data_vencimento": f"case when {_ENTRY} % 23 = 0 then '29/02/' || {_pad(f'year({_DUE})', 4)}"
                       f" when {_ENTRY} % 29 = 0 then 'nan' when {_ENTRY} % 31 = 0 then {_iso(_DUE)} || ' 00:00:00'"
                       f" when {_ENTRY} % 3 = 0 then {_iso(_DUE)} when {_ENTRY} % 3 = 1 then {_dmy(_DUE)}"
                       f" else {_mdy(_DUE)} end",
    "data_pagamento": f"case when l_linestatus = 'O' and {_ENTRY} % 3 = 0 then null"
                      f" when {_ENTRY} % 3 = 0 then {_mdy(_PAID)} when {_ENTRY} % 3 = 1 then {_iso(_PAID)}"
                      f" else {_dmy(_PAID)} end",
}

RECEIVABLES = Feed(
    tables="lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey",
    columns=_LEDGER | {
        "id_cliente": f"case when l_orderkey % 401 = 0 then null else {_text('o_custkey')} end",
        "status": f"case when {_ENTRY} % 17 = 0 then null when l_linestatus = 'F' then"
                  f" (case when {_ENTRY} % 2 = 0 then 'Recebido' else ' pago ' end)"
                  f" when {_ENTRY} % 2 = 0 then 'Em Aberto' else 'PENDENTE' end",
    },
    ordinal=_LINE,
)

PAYABLES = Feed(
    tables="lineitem join part on l_partkey = p_partkey",
    columns=_LEDGER | {
        "destino_pagamento_conta": "'fornecedor ' || " + _text("l_suppkey"),
        "status_conta": f"case when {_ENTRY} % 17 = 0 then null when l_linestatus = 'F' then 'Pago'"
                        " else 'Em Aberto' end",
        "observacao_conta": "case when l_returnflag = 'R' then 'devolvido' end",
    },
    ordinal=_LINE,
)

_QUOTED = "(date '1995-01-02' + cast((event_id * 37) % 420 * 6 + event_id % 3 as int))"

QUOTES = Feed(
    tables="events",
    columns={
        "moeda": _choose("user_id % 4", ["'USD'", "'EUR'", "'GBP'", "'CAD'"]),
        "data_hora_cotacao": f"case when event_id % 211 = 0 then null else {_iso(_QUOTED)} || ' ' ||"
                             f" {_pad('hour(ts)')} || ':00:00.000' end",
        "cotacao_compra": "case when event_id % 53 = 0 then null else value end",
        "cotacao_venda": "case when event_id % 59 = 0 then null else value + cast(0.05 as double) end",
    },
    ordinal=["event_id"],
)
QUOTED_CURRENCIES = ["CAD", "EUR", "GBP", "USD"]

_LONG_MONTH = _choose("m - 1", [
    "'janeiro'", "'fevereiro'", "'março'", "'abril'", "'maio'", "'junho'", "'julho'", "'agosto'", "'setembro'",
    "'outubro'", "'novembro'", "'dezembro'",
])

# Over one row per month of the orders: y, m and the number of orders n.
TARGETS = Feed(
    tables="months",
    columns={
        "mes_meta": f"case when m = 6 then '13/' || {_text('y')} when m = 7 then {_text('y')}"
                    f" when m % 3 = 0 then ' ' || {_LONG_MONTH} || ' de ' || {_text('y')}"
                    f" when m % 3 = 1 then {_pad('m')} || '/' || {_text('y')}"
                    f" else substr({_LONG_MONTH}, 1, 3) || './' || {_text('y')} end",
        "meta": f"case when m = 11 then 'abc' when m % 4 = 0 then '1,5k' when m % 5 = 0 then '1.234,50'"
                f" else {_text('n')} || 'k' end",
    },
    ordinal=["y", "m"],
)
MONTHS_SQL = "select year(o_orderdate) as y, month(o_orderdate) as m, count(*) as n from orders group by 1, 2"

# All names a category can have after cleaning: every part name is an adjective and a noun.
ADJECTIVES = ["blue", "cold", "hot", "large", "new", "old", "red", "small"]
NOUNS = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]


# What the ledger feeds repeat, computed once for a row, and their spellings of it as texts of the same value (years have
# four digits). Written out, the projection is too long a method for the JVM to compile.
_REPEATED = {"__entry": _ENTRY, "__due": _text(_DUE), "__paid": _text(_PAID)}
_SHORT = {
    spelled(day): short.format(name)
    for day, name in ((_DUE, "__due"), (_PAID, "__paid"))
    for spelled, short in (
        (_iso, "{0}"), (_dmy, "cast(cast(substr({0}, 9, 2) as int) as string) || '/' || substr({0}, 6, 2) || '/' || substr({0}, 1, 4)"),
        (_mdy, "substr({0}, 6, 5) || '-' || substr({0}, 1, 4)"), (lambda d: _pad(f"year({d})", 4), "substr({0}, 1, 4)"))
} | {_ENTRY: "__entry"}


def _read_ledger(feed: Feed, source: DataFrame) -> DataFrame:
    def short(text: str) -> str:
        return reduce(lambda t, pair: t.replace(*pair), _SHORT.items(), text)

    once = source.withColumns({name: F.expr(text) for name, text in _REPEATED.items()})
    return _read(replace(feed, columns={c: short(e) for c, e in feed.columns.items()}), once)


def _read(feed: Feed, source: DataFrame) -> DataFrame:
    columns = [f"{e} as {c}" for c, e in feed.columns.items()]
    return source.selectExpr(*columns, f"struct({', '.join(feed.ordinal)}) as {ORDINAL}")


class Tables:
    """The feeds of one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _lines(self) -> DataFrame:
        # The driver writes each table as one file of one row group, which a scan cannot split.
        return spread(self.table("lineitem")).join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))

    def clients(self) -> DataFrame:
        return _read(CLIENTS, spread(self.table("customer")))

    def categories(self) -> DataFrame:
        return _read(CATEGORIES, spread(self.table("part")))

    def receivables(self) -> DataFrame:
        lines = self._lines().join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return _read_ledger(RECEIVABLES, lines)

    def payables(self) -> DataFrame:
        return _read_ledger(PAYABLES, self._lines())

    def quotes(self) -> DataFrame:
        return _read(QUOTES, spread(self.table("events")))

    def targets(self) -> DataFrame:
        day = F.col("o_orderdate")
        months = self.table("orders").groupBy(F.year(day).alias("y"), F.month(day).alias("m")).agg(
            F.count(F.lit(1)).alias("n")
        )
        return _read(TARGETS, months)

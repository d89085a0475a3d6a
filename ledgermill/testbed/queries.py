"""Registered queries: every job of the library on the feeds of one folder of driver tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date
from functools import cached_property, reduce
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import LEDGER_LAYOUTS, month_key, parse_dates
from ..functions.fixed_values import VALUE_BANDS
from ..operators import append, calendar, checks, clustering, dedup, lookups, ordering, sketches
from ..plans import customers, pipeline, rates, reports, segments, silver, star
from ..schemas import GOLD_FOREIGN, GOLD_KEYS, GOLD_UNIQUE, MODEL_METRICS, RATE_PAYLOAD, SILVER
from ..sources import layers, loads
from ..sources.rate_payloads import flatten_payloads
from ..sources.shared import materialise, shared_folder, side_by_side
from .tables import ADJECTIVES, NOUNS, QUOTED_CURRENCIES, Tables

# Bounds of the rate window, so that clipping is exercised at both ends.
RATES_FROM, RATES_TO = date(1995, 3, 10), date(2001, 9, 20)

MIX_NAMES = [f"{a}_{n}" for a in ADJECTIVES for n in NOUNS] + ["sem_categoria"]
# So few that most categories fall into the rest.
FEW_NAMES = MIX_NAMES[::7]


class Ledger(Tables):
    """Cleaned, gold and feature tables, built on demand.

    As in the pipeline, a table that several steps read is written once and read back. A feed that one step reads is not: its step
    then computes the columns it needs and no others.
    """

    @cached_property
    def landed_receivables(self) -> DataFrame:
        return materialise(self.receivables())

    def quote_days(self) -> DataFrame:
        return rates.quote_days(rates.payment_months(self.receivables()), RATES_FROM, RATES_TO)

    def rates(self) -> DataFrame:
        return rates.complete_quotes(rates.latest_quotes(self.quotes()), self.quote_days(), QUOTED_CURRENCIES)

    @cached_property
    def written_rates(self) -> DataFrame:
        """As in the pipeline, rates are written: they are few, and the planner then knows it and shuffles no receivables for them."""
        return materialise(self.rates())

    def clean_clients(self) -> DataFrame:
        return silver.clean_clients(self.clients())

    def clean_receivables(self) -> DataFrame:
        clients, quotes = side_by_side(lambda: self.silver_clients, lambda: self.written_rates)
        return silver.clean_receivables(self.receivables(), clients, quotes)

    def unconverted_receivables(self) -> DataFrame:
        """For steps that read no amount in home currency, which need neither clients nor rates."""
        return silver.clean_receivables(self.receivables())

    @cached_property
    def landed_payables(self) -> DataFrame:
        return materialise(self.payables())

    def clean_payables(self) -> DataFrame:
        return silver.clean_payables(self.payables())

    def clean_categories(self) -> DataFrame:
        return silver.clean_categories(self.categories())

    def clean_targets(self) -> DataFrame:
        return silver.clean_targets(self.targets())

    @cached_property
    def silver_clients(self) -> DataFrame:
        return materialise(self.clean_clients())

    @cached_property
    def silver_receivables(self) -> DataFrame:
        return materialise(self.clean_receivables())

    @cached_property
    def silver_payables(self) -> DataFrame:
        return materialise(self.clean_payables())

    @cached_property
    def silver_targets(self) -> DataFrame:
        return materialise(self.clean_targets())

    @cached_property
    def star(self) -> star.Star:
        side_by_side(lambda: self.silver_receivables, lambda: self.silver_targets)
        return star.build_star(self.silver_clients, self.clean_categories(), self.silver_targets,
                               self.clean_payables(), self.silver_receivables)

    @cached_property
    def days(self) -> DataFrame:
        """The date dimension, for facts that need no other step of the star."""
        return materialise(dim_date(self))

    @cached_property
    def totals(self) -> DataFrame:
        return customers.client_totals(self.clean_receivables())

    @cached_property
    def features(self) -> DataFrame:
        return customers.client_features(star.dim_client(self.silver_clients), self.clean_receivables(), with_mix=False)

    @cached_property
    def wide_features(self) -> DataFrame:
        return customers.client_features(star.dim_client(self.silver_clients), self.silver_receivables,
                                         self.clean_categories(), MIX_NAMES)

    def segmented(self) -> DataFrame:
        """Features with a segment by rule, so that reports can be compared exactly."""
        return segments.segment_output(self.features, _segments_by_rule(self.features), "regra")


def _segments_by_rule(features: DataFrame) -> DataFrame:
    frequent = (F.col("frequencia_recebimentos") >= 30).cast("int")
    punctual = (F.col("taxa_pagamento_em_dia") >= 0.5).cast("int")
    return features.select("id_cliente", (frequent + 2 * punctual).alias("cluster"))


def _drop_ordinal(df: DataFrame) -> DataFrame:
    return df.drop(dedup.ORDINAL)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def revenue_by_month_currency_category(t: Ledger) -> DataFrame:
    s = t.star
    return star.roll_up(
        s.fato_conta_receber,
        [(s.dim_data, "sk_data_pagamento", "sk_data"), (s.dim_categoria, "sk_categoria", "sk_categoria"),
         (s.dim_moeda, "sk_moeda", "sk_moeda")],
        ["ano", "mes", "codigo_moeda", "tipo_categoria"], "valor_conta_brl",
    )


def revenue_by_client_year(t: Ledger) -> DataFrame:
    s = t.star
    return star.roll_up(
        s.fato_conta_receber,
        [(s.dim_data, "sk_data_vencimento", "sk_data"), (s.dim_cliente, "id_cliente", "id_cliente")],
        ["ano", "id_cliente", "pais_cliente"], "valor_conta_brl",
    )


def dim_date(t: Ledger) -> DataFrame:
    # Dates do not depend on conversion.
    return star.dim_date(t.clean_targets(), t.clean_payables(), t.unconverted_receivables())


def bronze_date_parse(t: Ledger) -> DataFrame:
    due = t.receivables().select("id_conta", F.col("data_vencimento").alias("sem_reparo"),
                                 F.col("data_vencimento").alias("com_reparo"))
    df = parse_dates(due, "sem_reparo", LEDGER_LAYOUTS)
    return parse_dates(df, "com_reparo", LEDGER_LAYOUTS, repair_feb29=True)


def fact_payable(t: Ledger) -> DataFrame:
    day, category, currency = side_by_side(
        lambda: t.days, lambda: materialise(star.dim_category(t.clean_categories())),
        lambda: materialise(star.dim_currency(t.silver_clients)))
    return star.fact_payable(t.clean_payables(), category, currency, day)


def fact_target(t: Ledger) -> DataFrame:
    targets, day = side_by_side(lambda: t.silver_targets, lambda: t.days)
    return star.fact_target(targets, day)


def target_currencies(t: Ledger) -> DataFrame:
    return rates.currencies_of_countries(t.silver_clients, "pais_cliente")


def quote_counts(t: Ledger) -> DataFrame:
    quotes = rates.latest_quotes(t.quotes())
    return rates.quote_counts(quotes, rates.complete_quotes(quotes, t.quote_days(), QUOTED_CURRENCIES))


def new_keys_only(t: Ledger) -> DataFrame:
    key = F.when(F.col("l_orderkey") % 13 != 0, F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_conta")
    lines = t.table("lineitem")
    held = lines.where(F.col("l_returnflag") == "R").select(key)
    return append.new_keys_only(lines.select(key, "l_partkey", "l_suppkey", "l_extendedprice"), held, ["id_conta"])


def new_part_keys_hot(t: Ledger) -> DataFrame:
    """New keys where one key has a third of the rows and hot keys are split."""
    key = F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_partkey")).cast("bigint").alias("chave")
    lines = t.table("lineitem")
    held = t.table("part").where("p_partkey % 2 = 0").select(F.col("p_partkey").cast("bigint").alias("chave"))
    return append.new_keys_only(lines.select(key, "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"), held, ["chave"],
                                split_hot=True)


def hot_client_currency(t: Ledger) -> DataFrame:
    """Currency of each order's client where one client has a third of the orders and hot keys are split."""
    client = F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")).cast("bigint").alias("id_cliente")
    orders = t.table("orders").select(F.col("o_orderkey").cast("bigint").alias("pedido"), client)
    currency = star.dim_client(t.silver_clients).select("id_cliente", "moeda_pais")
    return lookups.lookup_join(orders, currency, ["id_cliente"], split_hot=True)


def append_star_twice(t: Ledger) -> DataFrame:
    """Keys of three dimensions after a first load of a part and an append of the rest."""
    def twice(name: str, key: str, number: str, build: Callable, early, whole) -> DataFrame:
        first = materialise(build(early, None))
        second = materialise(build(whole, first))
        grown = first.unionByName(append.new_keys_only(second, first, GOLD_KEYS[name]))
        return grown.select(F.lit(name).alias("dimensao"), F.col(key).cast("string").alias("chave"), F.col(number).alias("sk"))

    categories, clients = materialise(t.clean_categories()), t.silver_clients
    payables, targets = t.silver_payables, t.silver_targets
    nothing = t.unconverted_receivables().where("false")
    dates = lambda ledger, held: star.dim_date(targets, ledger, nothing, held)
    return (
        twice("dim_categoria", "codigo_categoria", "sk_categoria", star.dim_category,
              categories.where("codigo_categoria >= 'Brand#3'"), categories)
        .unionByName(twice("dim_moeda", "codigo_moeda", "sk_moeda", star.dim_currency,
                           clients.where("moeda_pais >= 'E'"), clients))
        .unionByName(twice("dim_data", "data_calendario", "sk_data", dates,
                           payables.where("data_vencimento >= date '1998-01-01'"), payables))
    )


def _feed_folder(t: Ledger) -> str:
    return f"{shared_folder(t.spark)}/feeds-{uuid4().hex}"


def _clients_feed(t: Ledger) -> DataFrame:
    """The feed of clients with a text that needs quoting: commas, quotes and line feeds."""
    note = "'linha 1, \"' || id_cliente || '\"' || case when length(id_cliente) % 2 = 0 then chr(10) || 'linha 2' else '' end"
    return t.clients().select("id_cliente", "nome_cliente", "pais_cliente", "data_cadastro_cliente", F.expr(note).alias("nota"))


def landed_clients_csv(t: Ledger) -> DataFrame:
    folder = _feed_folder(t)
    layers.write_layer(_clients_feed(t), folder, "PS_Cliente", "csv")
    failed = pipeline.land(pipeline.raw_readers(t.spark, folder, {"PS_Cliente": "csv"}), f"{folder}/bronze")
    if failed:
        raise RuntimeError(str(failed))
    return _drop_ordinal(layers.read_layer(t.spark, f"{folder}/bronze", "PS_Cliente"))


def landed_clients_json(t: Ledger) -> DataFrame:
    """JSON Lines feed with a field that no schema declares."""
    folder = _feed_folder(t)
    _clients_feed(t).write.json(f"{folder}/PS_Cliente.jsonl")
    readers = pipeline.raw_readers(t.spark, folder, {"PS_Cliente": "jsonl"})
    layers.write_layer(readers["PS_Cliente"](), folder, "PS_Cliente", "csv")
    return _drop_ordinal(layers.read_layer(t.spark, folder, "PS_Cliente"))


def landed_quotes(t: Ledger) -> DataFrame:
    """Latest quotes out of landed payload documents, one per currency and month."""
    folder = _feed_folder(t)
    quote = F.struct(F.col("cotacao_compra").alias("cotacaoCompra"), F.col("cotacao_venda").alias("cotacaoVenda"),
                     F.col("data_hora_cotacao").alias("dataHoraCotacao"))
    month = F.substring("data_hora_cotacao", 1, 7)
    documents = t.quotes().groupBy("moeda", month.alias("mes")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(dedup.ORDINAL, quote.alias("q")))), lambda x: x["q"]).alias("value"))
    documents.select("moeda", F.to_json(F.struct("value")).alias("texto")).write.partitionBy("moeda").text(folder)
    answers = t.spark.read.option("basePath", folder).text(folder).select(
        "moeda", F.col("_metadata.file_path").alias("arquivo"), F.from_json("value", RATE_PAYLOAD)["value"].alias("value"))
    return rates.latest_quotes(flatten_payloads(answers, "moeda", "arquivo"))


def landed_folder(t: Ledger) -> DataFrame:
    """A folder with feeds of three kinds, landed as it is listed: table and number of rows."""
    folder = _feed_folder(t)
    for name, extension, feed in (("clientes", "csv", t.clients()), ("metas", "csv", t.targets()), ("categorias", "jsonl", t.categories())):
        if extension == "csv":
            layers.write_layer(feed.drop(dedup.ORDINAL), folder, name, "csv")
        else:
            feed.drop(dedup.ORDINAL).write.json(f"{folder}/{name}.{extension}")
    readers = pipeline.raw_readers(t.spark, folder)
    failed = pipeline.land(readers, f"{folder}/bronze")
    if failed:
        raise RuntimeError(str(failed))
    return reduce(DataFrame.unionByName, [
        layers.read_layer(t.spark, f"{folder}/bronze", name).agg(F.lit(name).alias("tabela"), F.count(F.lit(1)).alias("linhas"))
        for name in readers])


def _landed_in_blocks(t: Ledger, folder: str, name: str, extension: str) -> DataFrame:
    """A feed landed by a session of its own, whose blocks are so small that its files are split."""
    small = t.spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    failed = pipeline.land(pipeline.raw_readers(small, folder, {name: extension}), f"{folder}/bronze")
    if failed:
        raise RuntimeError(str(failed))
    return _drop_ordinal(layers.read_layer(t.spark, f"{folder}/bronze", name))


def split_lines_csv(t: Ledger) -> DataFrame:
    """Line items whose notes hold quotes, commas and line feeds, so that blocks and lines begin inside of cells."""
    note = ("'peca \"' || l_partkey || '\", ' || case l_linenumber % 4 when 0 then chr(10) || chr(10) || 'fim' when 1 then 'a' || chr(10) ||"
            " 'b,\"c' || chr(10) || '\"' when 2 then ',\"' else 'x' end")
    folder = _feed_folder(t)
    feed = t.table("lineitem").select(F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("linha"), F.expr(note).alias("nota"),
                                      F.col("l_suppkey").cast("string").alias("destino"))
    layers.write_layer(feed, folder, "linhas", "csv")
    return _landed_in_blocks(t, folder, "linhas", "csv")


def _as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One JSON array out of the records of a partition."""
    sign = "["
    for batch in batches:
        signs = [sign, *["," for _ in range(batch.num_rows - 1)]] if batch.num_rows else []
        yield pa.RecordBatch.from_arrays([pa.array([a + b for a, b in zip(signs, batch.column(0).to_pylist())], pa.string())], ["value"])
        sign = "," if batch.num_rows else sign
    yield pa.RecordBatch.from_arrays([pa.array(["]" if sign == "," else "[]"])], ["value"])


def split_orders_json(t: Ledger) -> DataFrame:
    """Orders as JSON arrays, with nested objects and with braces and quotes in texts."""
    folder = _feed_folder(t)
    note = F.expr("case o_orderkey % 4 when 0 then '}, {\"' when 1 then '[' || chr(10) when 2 then 'x' end")
    nested = F.when(F.col("o_orderkey") % 3 == 0, F.struct(F.col("o_orderstatus").alias("situacao"), F.struct(
        F.lit("{").alias("sinal"), F.col("o_custkey").alias("id")).alias("cliente")))
    feed = t.table("orders").select("o_orderkey", note.alias("nota"), nested.alias("extra"))
    feed.select(F.to_json(F.struct(*feed.columns)).alias("value")).mapInArrow(_as_array, "value string").write.text(f"{folder}/pedidos.json")
    return _landed_in_blocks(t, folder, "pedidos", "json")


def append_layer_twice(t: Ledger) -> DataFrame:
    """A layer table after a load of a part, one of the whole, a repetition of it, and one that breaks half-way."""
    table = loads.LoadTable(t.spark, _feed_folder(t), "linhas")
    lines = t.table("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("chave"), "l_partkey", "l_returnflag")
    table.append(lines.where("l_returnflag = 'R'").drop("l_returnflag"), ["chave"], "primeira")
    whole = lines.drop("l_returnflag").withColumn("l_partkey", F.col("l_partkey") + 1)
    for _ in range(2):
        table.append(whole, ["chave"], "segunda")
    broken = lines.select(F.col("chave") + 1_000_000_000, F.when(F.col("chave") % 1000 == 3, F.raise_error(F.lit("broken"))).otherwise(
        F.col("l_partkey")).cast("bigint").alias("l_partkey")).toDF("chave", "l_partkey")
    try:
        table.append(broken, ["chave"], "terceira")
    except Exception as error:  # noqa: BLE001 - the load is meant to break
        if "broken" not in str(error):
            raise
    return table.read().select("chave", "l_partkey", "carga")


def replaced_months(t: Ledger) -> DataFrame:
    """Payables by month due after a load of all and a correction of the months of one year."""
    table = loads.LoadTable(t.spark, _feed_folder(t), "contas")
    month = month_key(F.col("data_vencimento"))
    dated = t.silver_payables.select("id_conta", "valor_conta", month.alias("mes_vencimento"))
    table.replace(dated, "inicial")
    year = dated.where("mes_vencimento LIKE '1996%'")
    table.replace(year.where("id_conta % 2 = 0").withColumn("valor_conta", -F.col("valor_conta")), "correcao", "mes_vencimento")
    return table.read().groupBy("mes_vencimento", "carga").agg(
        F.count(F.lit(1)).alias("contas"), F.round(F.sum("valor_conta"), 2).alias("valor"))


def payable_quantiles_by_load(t: Ledger) -> DataFrame:
    """Quartiles of payables per status out of sketches of five loads, one of which is corrected later: the estimate with
    its bounds, and the exact value from the rows around it."""
    table = loads.LoadTable(t.spark, _feed_folder(t), "valores")
    rows = t.silver_payables.select("status_conta", "valor_conta", F.coalesce(F.year("data_vencimento") % 4, F.lit(4)).alias("parte"))
    value, by, shares = "valor_conta", ["status_conta"], [0.25, 0.5, 0.75]
    wrong = {"2": rows.where("parte = 2").withColumn(value, -F.col(value))}
    sketches.sketch_loads(table, {str(i): rows.where(F.col("parte") == i) for i in (0, 1, 3, 4)} | wrong, value, by)
    sketches.keep_sketch(table, sketches.value_sketch(rows.where("parte = 2"), value, by), "2", "correcao")
    whole = materialise(sketches.kept_sketch(table, by))
    exact = sketches.exact_quantiles(rows.drop("parte"), value, shares, whole, by)
    both = lookups.lookup_join(sketches.estimated_quantiles(whole, shares, by), exact, [*by, "parte"], null_safe=True)
    return _rounded(both, "estimativa", "minimo", "maximo", "quantil", digits=4)


def silver_layer_by_month(t: Ledger) -> DataFrame:
    """Payables written in directories by month due and read back with their declared schema."""
    folder = _feed_folder(t)
    dated = t.clean_payables().withColumn("mes_vencimento", month_key(F.col("data_vencimento")))
    layers.write_layer(dated, folder, "conta_pagar_silver", partition_by=["mes_vencimento"], sort_by=["id_conta"])
    return _drop_ordinal(layers.read_layer(t.spark, folder, "conta_pagar_silver", SILVER["conta_pagar_silver"]))


def sorted_layer_order(t: Ledger) -> DataFrame:
    """Payables written in the order of value due and id, with each row's place in the files that were written."""
    folder, order = _feed_folder(t), ["valor_conta", "id_conta"]
    keyed = t.silver_payables.where("id_conta is not null and valor_conta is not null").select(*order).distinct()
    layers.write_layer(keyed, folder, "contas", sort_by=order)
    placed = layers.read_layer(t.spark, folder, "contas").select(
        *order, F.col("_metadata.file_name").alias("arquivo"), F.col("_metadata.row_index").alias("linha"))
    return ordering.dense_key(placed, "posicao", ["arquivo", "linha"]).select("posicao", *order)


def first_clients(t: Ledger) -> DataFrame:
    """Preview of the client dimension."""
    return reports.first_rows(star.dim_client(t.silver_clients), ["pais_cliente", "id_cliente"])


def quality_targets(t: Ledger) -> DataFrame:
    targets = t.clean_targets()
    return targets.agg(*checks.complete_rows([c for c in targets.columns if c != dedup.ORDINAL]))


def quality_categories(t: Ledger) -> DataFrame:
    return checks.before_and_after(t.categories(), t.clean_categories())


def quality_clients(t: Ledger) -> DataFrame:
    counts = checks.missing("pais_cliente", "moeda_pais", "data_cadastro_cliente")
    return checks.before_and_after(t.clients(), t.clean_clients(), *counts)


def quality_ledgers(t: Ledger) -> DataFrame:
    def line(name: str, raw: DataFrame, clean: DataFrame, paid, still_open) -> DataFrame:
        counts = checks.before_and_after(
            raw, clean, F.count_if(paid).alias("pagas"), F.count_if(still_open).alias("abertas")
        )
        return counts.withColumn("tabela", F.lit(name))

    return line(
        "conta_pagar", t.landed_payables, silver.clean_payables(t.landed_payables),
        checks.status_is("status_conta", "pago"), checks.status_is("status_conta", "em aberto"),
    ).unionByName(line(
        "conta_receber", t.landed_receivables, silver.clean_receivables(t.landed_receivables),
        checks.status_like("status_conta", "recebido|pago"), checks.status_like("status_conta", "aberto|pendente"),
    ))


def silver_quality_log(t: Ledger) -> DataFrame:
    """Figures that the silver job counts while it writes its tables."""
    folder = _feed_folder(t)
    feeds = {"PS_Conta_Receber": lambda: t.receivables(), "PS_Conta_Pagar": lambda: t.payables(), "PS_Cliente": lambda: t.clients(),
             "PS_Categoria": lambda: t.categories(), "PS_Meta2025": lambda: t.targets()}
    failed = pipeline.land(feeds, f"{folder}/bronze")
    if failed:
        raise RuntimeError(str(failed))
    pipeline.run_silver(t.spark, f"{folder}/bronze", f"{folder}/silver")
    return layers.read_layer(t.spark, f"{folder}/silver", pipeline.QUALITY)


def quality_keys(t: Ledger) -> DataFrame:
    """Repeated primary keys and orphan foreign keys of the gold tables, as numbers of keys."""
    return checks.key_violations(t.star.tables(), GOLD_UNIQUE, GOLD_FOREIGN)


def client_value_band(t: Ledger) -> DataFrame:
    features = t.features.select("id_cliente", "valor_total_recebido_brl", "faixa_valor_cliente")
    ranked = customers.percentile_ranks(features, "valor_total_recebido_brl")
    return ranked.select("id_cliente", "valor_total_recebido_brl", "rank_pct", "faixa_valor_cliente")


def client_rfm(t: Ledger) -> DataFrame:
    return customers.client_rfm(t.totals)


def client_behaviour(t: Ledger) -> DataFrame:
    return _rounded(customers.client_behaviour(t.totals), "variancia_dias_atraso", "desvio_dias_atraso")


def client_category_mix(t: Ledger) -> DataFrame:
    return customers.category_mix(t.unconverted_receivables(), t.clean_categories())


def client_category_mix_wide(t: Ledger) -> DataFrame:
    wide = customers.mix_columns(customers.category_mix(t.unconverted_receivables(), t.clean_categories()), FEW_NAMES)
    return _rounded(wide, *wide.columns[1:], digits=9)


def client_features(t: Ledger) -> DataFrame:
    return _rounded(
        t.wide_features, "variancia_dias_atraso", "desvio_dias_atraso",
        "valor_total_recebido_brl_log1p", "valor_medio_recebido_brl_log1p",
    )


def band_statistics(t: Ledger) -> DataFrame:
    return _rounded(reports.band_statistics(t.features), "media", "mediana", digits=4)


def tercile_cutoffs(t: Ledger) -> DataFrame:
    return _rounded(reports.tercile_cutoffs(t.features), "corte_1", "corte_2", digits=4)


def country_counts(t: Ledger) -> DataFrame:
    return reports.value_counts(t.silver_clients, "pais_cliente")


def country_band_crosstab(t: Ledger) -> DataFrame:
    return reports.crosstab(t.features, "pais_cliente", "faixa_valor_cliente", VALUE_BANDS)


def country_segment_crosstab(t: Ledger) -> DataFrame:
    return reports.crosstab(t.segmented(), "pais_cliente", "cluster", [0, 1, 2])


def currency_counts(t: Ledger) -> DataFrame:
    return reports.value_counts(t.segmented(), "moeda_pais")


def band_counts(t: Ledger) -> DataFrame:
    return reports.value_counts(t.segmented(), "faixa_valor_cliente")


def segment_profile(t: Ledger) -> DataFrame:
    return _rounded(reports.segment_profile(t.segmented()), "recencia_media", "frequencia_media", "valor_medio",
                    "em_dia_pct", digits=4)


def segment_five_numbers(t: Ledger) -> DataFrame:
    return _rounded(reports.five_numbers(t.segmented()), "q1", "mediana", "q3", digits=4)


def segment_five_numbers_by_sketch(t: Ledger) -> DataFrame:
    return _rounded(reports.five_numbers_by_sketch(t.segmented()), "q1", "mediana", "q3", digits=4)


def segment_centroids(t: Ledger) -> DataFrame:
    axes = t.segmented().select(
        "cluster", F.col("recencia_dias").alias("x"), F.col("valor_total_recebido_brl").alias("y")
    )
    return _rounded(reports.centroids(axes, ["x", "y"]), "x", "y", digits=4)


def _brand_metrics(t: Ledger) -> DataFrame:
    """A metric table like that of the candidate models, with one row per brand and ties in every metric."""
    lines = t.table("lineitem").join(t.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.groupBy(F.col("p_brand").alias("model_name")).agg(
        F.count(F.lit(1)).alias("n_clusters"),
        F.lit(0.0).alias("noise_ratio"),
        F.floor(F.max("l_extendedprice") / 1000).cast("double").alias("silhouette"),
        F.min("l_quantity").alias("davies_bouldin"),
        F.floor(F.min("l_extendedprice") / 10).cast("double").alias("calinski_harabasz"),
    )


def model_ranks(t: Ledger) -> DataFrame:
    return segments.rank_models(_brand_metrics(t))


def top_models(t: Ledger) -> DataFrame:
    return segments.top_models(segments.rank_models(_brand_metrics(t)))


def cluster_model_comparison(t: Ledger) -> DataFrame:
    mix = customers.category_mix(t.unconverted_receivables(), t.clean_categories())
    return segments.compare_clusterings(t.features, mix=mix).comparison


def feature_mix_entries(t: Ledger) -> DataFrame:
    """The vector of one number and the whole category mix."""
    used = t.features.select("id_cliente", F.col("recencia_dias").cast("double").alias("recencia_dias"))
    mix = customers.category_mix(t.unconverted_receivables(), t.clean_categories())
    return _rounded(segments.entries(segments.feature_vectors(used, mix=mix)).where("abs(valor) > 1e-9"), "valor")


def cluster_pca(t: Ledger) -> DataFrame:
    vectors = materialise(segments.feature_vectors(t.wide_features))
    placed, explained = segments.project_2d(vectors, _segments_by_rule(t.wide_features))
    return reports.centroids(placed, ["pc1", "pc2"]).withColumns({
        "variancia_pc1": F.lit(explained[0]), "variancia_pc2": F.lit(explained[1]),
    })


def pca_of_blocks(t: Ledger) -> DataFrame:
    """Axes of five columns that are copies of two: three of one and two of the other."""
    copies = {"saldo": F.col("c_acctbal"), "resto": (F.col("c_custkey") % 97).cast("double")}
    used = t.table("customer").select(F.col("c_custkey").cast("bigint").alias("id_cliente"), *[
        copies[name].alias(f"{name}_{i}") for name, times in (("saldo", 3), ("resto", 2)) for i in range(times)])
    vectors = segments.feature_vectors(used)
    placed, explained = segments.project_2d(vectors, vectors.select("id_cliente"))
    return _rounded(placed.select("id_cliente", F.abs("pc1").alias("pc1"), F.abs("pc2").alias("pc2")).withColumns({
        "parte_1": F.lit(explained[0]), "parte_2": F.lit(explained[1])}), "pc1", "pc2", "parte_1", "parte_2")


_AXES = ["recencia_dias", "taxa_pagamento_em_dia"]


def _two_axes(t: Ledger) -> DataFrame:
    """Vectors of two standardised features, with the segment by rule."""
    vectors = segments.feature_vectors(t.features.select("id_cliente", *[F.col(c).cast("double") for c in _AXES]))
    return vectors.withColumn("features", segments.dense(F.col("features"))).join(_segments_by_rule(t.features), "id_cliente")


def segment_quality(t: Ledger) -> DataFrame:
    """Metrics of the segments by rule; those of one segment alone, with all others as noise, are degenerate."""
    labelled = materialise(_two_axes(t))
    alone = labelled.withColumn("cluster", F.when(F.col("cluster") == 0, 0).otherwise(-1))
    found = [segments.labelling_metrics(labelled, "regra"), segments.labelling_metrics(alone, "um_grupo")]
    rows = [tuple(metrics[f] for f in MODEL_METRICS.fieldNames()) for metrics in found]
    return _rounded(t.spark.createDataFrame(rows, MODEL_METRICS), "noise_ratio", "silhouette", "davies_bouldin", "calinski_harabasz",
                    digits=5)


def feature_vector_entries(t: Ledger) -> DataFrame:
    """The standardised and one-hot vector in long form."""
    used = t.features.select("id_cliente", *[F.col(c).cast("double") for c in _AXES], "faixa_valor_cliente")
    return _rounded(segments.entries(segments.feature_vectors(used)).where("abs(valor) > 1e-9"), "valor")


def feature_levels(t: Ledger) -> DataFrame:
    """The vector of two text columns with as many levels as there are parts and orders."""
    lines = t.table("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("id_cliente"), F.col("l_quantity").alias("quantidade"),
        F.concat(F.lit("peca "), "l_partkey").alias("peca"), F.concat(F.lit("pedido "), "l_orderkey").alias("pedido"))
    return _rounded(segments.entries(segments.feature_vectors(lines)).where("abs(valor) > 1e-9"), "valor")


def pca_of_two(t: Ledger) -> DataFrame:
    """Axes of two standardised features, without their signs, which are free."""
    vectors = segments.feature_vectors(t.features.select("id_cliente", *[F.col(c).cast("double") for c in _AXES]))
    placed, explained = segments.project_2d(vectors, _segments_by_rule(t.features))
    return _rounded(placed.select("id_cliente", F.abs("pc1").alias("pc1"), F.abs("pc2").alias("pc2")).withColumns({
        "parte_1": F.lit(explained[0]), "parte_2": F.lit(explained[1])}), "pc1", "pc2", "parte_1", "parte_2")


def forced_clusters(t: Ledger) -> DataFrame:
    """Both families on clients in three groups so far apart that the grouping is forced; a group is its least id."""
    key = F.col("c_custkey")
    place = F.element_at(F.array(*[F.lit(x) for x in (0.0, 1000.0, 9000.0)]), (key % 3 + 1).cast("int")) + key % 7
    rows = clustering.Rows.of(_points(t, [place, (key % 5).cast("double")]))
    run = clustering.best_runs(clustering.kmeans_runs(rows, [3], 3))[3]
    tree = clustering.ward_hierarchy(rows, [3])
    return _groups(rows, {"kmeans": (run.centres, np.arange(3)), "agglomerative": (tree.seeds, tree.labels[3])}, "familia").select(
        "familia", "id_cliente", "grupo")


def _points(t: Ledger, values: list[Column]) -> DataFrame:
    """Customers at a place, as sparse vectors."""
    features = F.struct(F.lit(len(values)).alias("size"), F.array(*[F.lit(i) for i in range(len(values))]).alias("indices"),
                        F.array(*values).alias("values"))
    return t.table("customer").select(F.col("c_custkey").cast("bigint").alias("id_cliente"), features.alias("features"))


def _groups(rows: clustering.Rows, labellings: dict, name: str) -> DataFrame:
    """Rows under each labelling with the least id of their cluster."""
    parts = [clustering.labelled(rows, labelling).select(F.lit(one).alias(name), F.col("key").alias("id_cliente"), "cluster")
             for one, labelling in labellings.items()]
    labelled = materialise(reduce(DataFrame.unionByName, parts))
    least = labelled.groupBy(name, "cluster").agg(F.min("id_cliente").alias("grupo"))
    return labelled.join(least, [name, "cluster"])


def forced_candidates(t: Ledger) -> DataFrame:
    """Every candidate of the model comparison on eight groups, each four times as far out as the one before, so that the
    clusters of every count are forced: its clusters by their least ids, and its cost."""
    key = F.col("c_custkey")
    place = F.when(key % 8 > 0, F.pow(F.lit(4.0), (key % 8).cast("double"))).otherwise(0.0) + (key % 5) / 10
    rows = clustering.Rows.of(_points(t, [place]))
    found = segments.candidates(rows, restarts=5)
    figures = clustering.labelling_figures(rows, found)
    costs = t.spark.createDataFrame([(name, one["n_clusters"], one["cost"]) for name, one in figures.items()],
                                    "model_name string, n_clusters bigint, custo double")
    sizes = _groups(rows, found, "model_name").groupBy("model_name", "grupo").agg(F.count(F.lit(1)).alias("clientes"))
    return _rounded(sizes.join(costs, "model_name"), "custo", digits=2)


JOBS: dict[str, Callable[[Ledger], DataFrame]] = {
    "revenue_by_month_currency_category": revenue_by_month_currency_category,
    "revenue_by_client_year": revenue_by_client_year,
    "clean_targets": lambda t: _drop_ordinal(t.clean_targets()),
    "clean_categories": lambda t: t.clean_categories(),
    "clean_clients": lambda t: _drop_ordinal(t.clean_clients()),
    "clean_payables": lambda t: _drop_ordinal(t.clean_payables()),
    "clean_receivables_fx": lambda t: _drop_ordinal(t.clean_receivables()),
    "bronze_date_parse": bronze_date_parse,
    "payment_months": lambda t: rates.payment_months(t.receivables()),
    "quote_date_islands": lambda t: calendar.contiguous_ranges(rates.latest_quotes(t.quotes()), "data"),
    "latest_quotes": lambda t: rates.latest_quotes(t.quotes()),
    "complete_quotes": lambda t: t.rates(),
    "target_currencies": target_currencies,
    "quote_counts": quote_counts,
    "dim_client": lambda t: star.dim_client(t.silver_clients),
    "dim_category": lambda t: star.dim_category(t.clean_categories()),
    "dim_currency": lambda t: star.dim_currency(t.silver_clients),
    "dim_date": dim_date,
    "fact_receivable": lambda t: t.star.fato_conta_receber,
    "fact_payable": fact_payable,
    "fact_target": fact_target,
    "new_keys_only": new_keys_only,
    "new_part_keys_hot": new_part_keys_hot,
    "hot_client_currency": hot_client_currency,
    "append_star_twice": append_star_twice,
    "landed_clients_csv": landed_clients_csv,
    "landed_clients_json": landed_clients_json,
    "landed_quotes": landed_quotes,
    "silver_layer_by_month": silver_layer_by_month,
    "segment_quality": segment_quality,
    "feature_vector_entries": feature_vector_entries,
    "pca_of_two": pca_of_two,
    "forced_clusters": forced_clusters,
    "forced_candidates": forced_candidates,
    "feature_levels": feature_levels,
    "feature_mix_entries": feature_mix_entries,
    "pca_of_blocks": pca_of_blocks,
    "append_layer_twice": append_layer_twice,
    "replaced_months": replaced_months,
    "payable_quantiles_by_load": payable_quantiles_by_load,
    "landed_folder": landed_folder,
    "split_lines_csv": split_lines_csv,
    "split_orders_json": split_orders_json,
    "sorted_layer_order": sorted_layer_order,
    "first_clients": first_clients,
    "quality_targets": quality_targets,
    "quality_categories": quality_categories,
    "quality_clients": quality_clients,
    "quality_ledgers": quality_ledgers,
    "silver_quality_log": silver_quality_log,
    "quality_keys": quality_keys,
    "column_profile": lambda t: checks.column_profile(_drop_ordinal(t.clean_clients())),
    "client_rfm": client_rfm,
    "client_behaviour": client_behaviour,
    "client_category_mix": client_category_mix,
    "client_category_mix_wide": client_category_mix_wide,
    "client_features": client_features,
    "client_value_band": client_value_band,
    "band_statistics": band_statistics,
    "tercile_cutoffs": tercile_cutoffs,
    "country_counts": country_counts,
    "country_band_crosstab": country_band_crosstab,
    "distinct_due_dates": lambda t: reports.distinct_values(t.clean_payables(), "data_vencimento"),
    "segment_output": lambda t: t.segmented(),
    "country_segment_crosstab": country_segment_crosstab,
    "currency_counts": currency_counts,
    "band_counts": band_counts,
    "segment_profile": segment_profile,
    "segment_five_numbers": segment_five_numbers,
    "segment_five_numbers_by_sketch": segment_five_numbers_by_sketch,
    "segment_centroids": segment_centroids,
    "model_ranks": model_ranks,
    "top_models": top_models,
    "cluster_model_comparison": cluster_model_comparison,
    "cluster_pca": cluster_pca,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def on_folder(job: Callable[[Ledger], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: job(Ledger(spark, folder))

    return {name: on_folder(job) for name, job in JOBS.items()}

import json
import os
import random
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgermill.operators.dedup import ORDINAL, first_arrived, last_arrived
from ledgermill.plans import pipeline
from ledgermill.schemas import GOLD, GOLD_KEYS, RAW, SILVER
from ledgermill.sources import database, layers, rate_payloads, shared, split_records

from .conftest import rows


def test_csv_cells_are_text_and_missing_tokens_null(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1.10,x\nNA,"say ""hi"", then go"\n,null\n007,nan\n', encoding="utf-8")
    df = layers.read_csv(spark, str(path))
    assert rows(df.select("a", "b"), "a")[0:2] == [(None, 'say "hi", then go'), (None, None)]
    assert rows(df.select("a", "b").where("a is not null"), "a") == [("007", None), ("1.10", "x")]


def test_csv_cells_may_span_lines_but_not_exceed_the_header(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,"x\ny"\n2\n3,z\n', encoding="utf-8")
    assert rows(layers.read_csv(spark, str(path)).select("a", "b"), "a") == [("1", "x\ny"), ("2", None), ("3", "z")]
    (tmp_path / "wide.csv").write_text("a,b\n1,x\n2,y,surplus\n", encoding="utf-8")
    with pytest.raises(Exception, match="More cells than columns"):
        layers.read_csv(spark, str(tmp_path / "wide.csv")).collect()
    layers.write_layer(layers.read_csv(spark, str(path)), str(tmp_path), "landed", "csv")
    landed = layers.read_layer(spark, str(tmp_path), "landed")
    assert [r.a for r in landed.orderBy(ORDINAL).collect()] == ["1", "2", "3"]


def test_json_keeps_undeclared_fields_and_refuses_broken_records(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "status": "pago", "x": {"y": [1, 2]}}\n{"id": 2.50, "z": true}\n', encoding="utf-8")
    df = layers.read_json(spark, str(tmp_path / "a.jsonl"), one_array=False).drop(ORDINAL)
    assert rows(df.select("id", "status", "x", "z"), "id") == [("1", "pago", '{"y":["1","2"]}', None), ("2.50", None, None, "true")]
    (tmp_path / "b.jsonl").write_text('{"id": 1}\n{"id": \n', encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        layers.read_json(spark, str(tmp_path / "b.jsonl"), one_array=False).collect()


def test_json_array_and_lines(spark, tmp_path):
    records = [{"id": 1, "n": "a"}, {"id": 2}, {"n": "ç"}]
    (tmp_path / "array.json").write_text(json.dumps(records), encoding="utf-8")
    (tmp_path / "lines.jsonl").write_text("\n".join(json.dumps(r) for r in records), encoding="utf-8")
    expected = [(None, "ç"), ("1", "a"), ("2", None)]
    for name, one_array in (("array.json", True), ("lines.jsonl", False)):
        df = layers.read_json(spark, str(tmp_path / name), one_array)
        assert rows(df.select("id", "n"), "id") == expected


@pytest.fixture
def small_blocks(spark):
    before = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key in before:
        spark.conf.set(key, "16000")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_csv_equals_the_whole_file_reader(spark, tmp_path, small_blocks, end):
    cells = ['"a ""b"", \nc"', '"line\n\nmore,""\n"', 'st"ray', "", '""', '"q"tail', "w" * 30, '"' + "deep\n" * 1500 + '"', "null"]
    rng = random.Random(4)
    pick = lambda: cells[rng.choice([0, 1, 2, 3, 4, 5, 6, 8, 0, 6, 6, 7 if rng.random() < 0.03 else 6])]
    text = "\n" + "\n".join(['a,"b\n1",c', *[f"{i},{pick()},{pick()}" for i in range(900)]]) + "\n\n"
    for name in ("x", "y"):
        (tmp_path / f"{name}.csv").write_bytes(text.replace("\n", end).encode())
    df = layers.read_csv(spark, str(tmp_path))
    whole = spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path / "x.csv"))
    expected = [tuple(None if x == "null" else x for x in r) for r in whole.collect()]
    assert len(expected) == 900 and df.columns == [*whole.columns, ORDINAL]
    assert [tuple(r)[:-1] for r in df.orderBy(ORDINAL).collect()] == expected * 2
    (tmp_path / "wide.csv").write_text('a,b\n1,"x\n"\n2,"y\n",surplus\n')
    with pytest.raises(Exception, match="More cells than columns"):
        layers.read_csv(spark, str(tmp_path / "wide.csv")).collect()


def test_split_json_equals_the_whole_file_reader(spark, tmp_path, small_blocks):
    rng = random.Random(5)
    records = [{"i": i, "t": rng.choice(["x", "a}b", 'q"{', "back\\", "{[", "é}\n"]) * rng.randrange(300 if i == 7 else 4),
                "n": rng.choice([None, {"k": {"z": [{"y": "}"}]}}, {"o": 3.50}])} for i in range(400)]
    for indent in (None, 2):
        path = str(tmp_path / f"{indent}.json")
        with open(path, "w", encoding="utf-8") as file:
            json.dump(records, file, indent=indent, ensure_ascii=False)
        whole = spark.read.options(multiLine=True, primitivesAsString=True).json(path).withColumn("n", F.to_json("n"))
        got = layers.read_json(spark, path).orderBy(ORDINAL).collect()
        assert [tuple(r)[:-1] for r in got] == [tuple(r) for r in whole.collect()] and len(got) == 400
    for broken in ('[{"a": 1}, {"a": 2', '[{"a": 1} {"a": 2}}, {"a": 3}]', '[{"a": "1}]'):
        (tmp_path / "broken.json").write_text(broken)
        with pytest.raises(Exception, match="(?i)malformed|parse"):
            layers.read_json(spark, str(tmp_path / "broken.json")).collect()
    (tmp_path / "none.json").write_text("[]\n")
    assert layers.read_json(spark, str(tmp_path / "none.json")).collect() == []


def test_small_blocks_share_tasks_and_lines_are_not_shuffled(spark, tmp_path, small_blocks):
    path = tmp_path / "many.csv"
    path.write_text("a,b\n" + "".join(f'{i},"x{chr(10) if i % 9 == 0 else ""}y"\n' for i in range(150_000)), encoding="utf-8")
    most = 4 * spark.sparkContext.defaultParallelism
    lines = split_records._parts(spark, str(path), "\n")
    assert lines.select("block").distinct().count() > most >= lines.rdd.getNumPartitions()
    records = split_records.csv_records(spark, str(path))
    plan = records._jdf.queryExecution().executedPlan().toString()
    # Only records of several lines are shuffled, and the lines that tell the states of blocks.
    assert "SortMergeJoin [file" not in plan
    assert records.count() == 150_000


def test_arrival_order_survives_splitting(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("k,n\n" + "".join(f"{i % 7},{i}\n" for i in range(20_000)), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = layers.read_csv(spark, str(path))
        assert df.rdd.getNumPartitions() > 3
        layers.write_layer(df, str(tmp_path), "landed")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    landed = layers.read_layer(spark, str(tmp_path), "landed").repartition(5)
    assert sorted(int(r.n) for r in first_arrived(landed, ["k"]).collect()) == list(range(7))
    assert sorted(int(r.n) for r in last_arrived(landed, ["k"]).collect()) == list(range(19_993, 20_000))
    ordered = [int(r.n) for r in landed.orderBy(ORDINAL).collect()]
    assert ordered == list(range(20_000))


def test_layers_prefer_parquet_and_fall_back_to_csv(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.createDataFrame([("c1", "n", None)], SILVER["categoria_silver"])
    with pytest.raises(FileNotFoundError):
        layers.read_layer(spark, folder, "categoria_silver")
    layers.write_layer(df, folder, "categoria_silver", "csv")
    assert rows(layers.read_layer(spark, folder, "categoria_silver", SILVER["categoria_silver"])) == [("c1", "n", None)]
    layers.write_layer(df.withColumn("nome_categoria", F.lit("p")), folder, "categoria_silver")
    assert layers.read_layer(spark, folder, "categoria_silver").first().nome_categoria == "p"


def test_partitioned_write_splits_a_large_directory(spark, tmp_path):
    df = spark.range(4000).select("id", F.when(F.col("id") < 3000, "a").otherwise("b").alias("m"))
    advised = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advised)
    spark.conf.set(advised, "2000")
    try:
        layers.write_layer(df, str(tmp_path), "t", partition_by=["m"], sort_by=["id"])
    finally:
        spark.conf.set(advised, before)
    assert len(list((tmp_path / "t.parquet" / "m=a").glob("*.parquet"))) > 1
    read = layers.read_layer(spark, str(tmp_path), "t")
    assert read.count() == 4000
    assert "PartitionFilters: [isnotnull(m" in read.where("m = 'b'")._jdf.queryExecution().executedPlan().toString()


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("m"))
    counts = {"grandes": F.count_if(F.col("id") >= 990)}
    for i, layout in enumerate(({}, {"sort_by": ["id"]}, {"partition_by": ["m"], "sort_by": ["id"]})):
        for j, output in enumerate(("parquet", "csv")):
            assert layers.write_layer(df, str(tmp_path), f"t{i}{j}", output, counts=counts, **layout) == {"linhas": 1000, "grandes": 10}
            assert layers.write_layer(df.where("id < 0"), str(tmp_path), f"e{i}{j}", output, counts=counts, **layout) == {"linhas": 0, "grandes": 0}
    nothing = spark.createDataFrame([], "id bigint, m bigint")
    assert layers.write_layer(nothing, str(tmp_path), "n", counts=counts, sort_by=["id"]) == {"linhas": 0, "grandes": 0}
    assert [r.id for r in layers.read_layer(spark, str(tmp_path), "t10").collect()] == list(range(1000))  # in the order of the files


def test_files_are_listed_in_order(spark, tmp_path):
    for name in ("b.csv", "a.csv", "c.json"):
        (tmp_path / name).write_text("x\n1\n")
    names = [r.path.rsplit("/", 1)[1] for r in layers.list_files(spark, str(tmp_path), "csv").collect()]
    assert names == ["a.csv", "b.csv"]


def _payload(*quotes):
    return json.dumps({"value": [
        {"cotacaoCompra": b, "cotacaoVenda": s, "dataHoraCotacao": t} for b, s, t in quotes]})


def test_rate_payloads(spark, tmp_path):
    for currency, text in (("USD", _payload((5.0, 5.1, "2025-01-02 13:00:00.000"), (1.0, 1.1, None))),
                           ("EUR", _payload()), ("CAD", _payload((3.0, 3.1, "2025-01-02 10:00:00.000")))):
        (tmp_path / f"moeda={currency}").mkdir()
        (tmp_path / f"moeda={currency}" / "p.json").write_text(text)
    df = rate_payloads.read_rate_payloads(spark, str(tmp_path)).drop(ORDINAL)
    assert rows(df) == [("CAD", "2025-01-02 10:00:00.000", 3.0, 3.1), ("USD", "2025-01-02 13:00:00.000", 5.0, 5.1),
                        ("USD", None, 1.0, 1.1)]


def test_materialised_tables_lie_in_the_shared_folder(spark):
    df = shared.materialise(spark.range(3).withColumn("x", F.rand()))
    assert rows(df) == rows(df)
    assert spark.conf.get("spark.checkpoint.dir") + "/ledgermill-" in df.inputFiles()[0]


def test_a_run_removes_its_intermediate_tables(spark):
    with shared.removing_tables(spark):
        inside = shared.materialise(spark.range(3))
        assert inside.count() == 3
    folder = spark.conf.get("spark.checkpoint.dir")
    assert not os.path.exists(inside.inputFiles()[0].removeprefix("file://")) and os.path.isdir(folder)
    outside = shared.materialise(spark.range(3))
    assert outside.count() == 3


def test_insert_options():
    options = database.insert_options("jdbc:x", "s.t", 4, truncate="true", user="u")
    assert options == {"url": "jdbc:x", "dbtable": "s.t", "batchsize": 5000, "numPartitions": 4, "truncate": "true",
                       "user": "u"}
    assert list(GOLD_KEYS) == list(GOLD) and list(GOLD_KEYS)[0].startswith("dim_")


def test_unknown_load_mode(spark):
    with pytest.raises(ValueError, match="replace, append"):
        database.load_star({}, "jdbc:x", mode="merge")


@pytest.fixture(scope="module")
def layered(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    raw, bronze, silver, gold, ml, payloads = (str(root / n) for n in
                                               ("raw", "bronze", "silver", "gold", "ml", "payloads"))
    (root / "raw").mkdir()

    def put(name, text):
        (root / "raw" / name).write_text(text, encoding="utf-8")

    put("PS_Meta2025.csv", "mes_meta,meta\n01/2025,700k\n março de 2025,750k\nago./2025,750k\n")
    put("PS_Categoria.csv", "codigo_categoria,nome_categoria,tipo_categoria\nc1,,receita\nc1,VENDA À VISTA,receita\n"
                            "c2,FRETES,Despesa\n,x,y\n")
    people = [{"id_cliente": i, "nome_cliente": f" ana {i} ", "pais_cliente": p, "data_cadastro_cliente": "2023-01-05"}
              for i, p in enumerate(["BRASIL", "FranÃ§a", "USA", " brasil", "Chile", "uk"] * 4)]
    put("PS_Cliente.json", json.dumps(people))
    put("PS_Conta_Pagar.csv", ",".join(RAW["PS_Conta_Pagar"]) + "\n1,a,x,c2,10.0,29/02/2025,01-31-2025,Pago\n"
                              "1,a,x,c2,12.0,2025-02-10,,Em Aberto\n")
    lines = [f"{i},r,{i % 24},c{i % 3},{100 + i},2025-01-{1 + i % 28:02d},{'' if i % 5 == 0 else '15/01/2025'},Pago"
             for i in range(200)]
    put("PS_Conta_Receber.csv", ",".join(RAW["PS_Conta_Receber"]) + ",status\n" + "\n".join(lines) + "\n")
    for currency, rate in (("EUR", 6.0), ("USD", 5.0), ("GBP", 7.0)):
        (root / "payloads" / f"moeda={currency}").mkdir(parents=True)
        (root / "payloads" / f"moeda={currency}" / "p.json").write_text(
            _payload((rate - 0.1, rate, "2025-01-10 13:00:00.000")))

    readers = pipeline.raw_readers(spark, raw)
    assert sorted(readers) == sorted(RAW)
    readers["PS_Ausente"] = lambda: layers.read_csv(spark, raw + "/none.csv")
    failed = pipeline.land(readers, bronze)
    pipeline.run_rates(spark, payloads, bronze, ["FRANCA", "ESTADOS UNIDOS", "REINO UNIDO", "BRASIL", "ATLANTIS"])
    pipeline.run_silver(spark, bronze, silver)
    star = pipeline.run_gold(spark, silver, gold)
    pipeline.run_segments(spark, silver, ml, restarts=1)
    return failed, bronze, silver, star, ml


def test_layers_as_csv_and_without_rates_or_clients(spark, layered, tmp_path):
    bronze, silver, gold, ml = (str(tmp_path / n) for n in ("bronze", "silver", "gold", "ml"))
    landed = {name: layers.read_layer(spark, layered[1], name) for name in RAW}
    landed["PS_Cliente"] = landed["PS_Cliente"].where("false")
    assert pipeline.land({name: (lambda df=df: df) for name, df in landed.items()}, bronze, "csv") == {}
    pipeline.run_silver(spark, bronze, silver, "csv")
    ledger = layers.read_layer(spark, silver, "conta_receber_silver", SILVER["conta_receber_silver"])
    assert ledger.count() == 200 and ledger.where("valor_conta != valor_conta_brl").isEmpty()
    star = pipeline.run_gold(spark, silver, gold)
    assert star.fato_conta_receber.count() == 200 and star.dim_cliente.count() == 0
    assert (tmp_path / "gold" / "fato_conta_receber.parquet" / "mes_vencimento=2025-01-01").exists()
    pipeline.run_segments(spark, silver, ml, restarts=1)
    assert layers.read_layer(spark, ml, "cliente_clusterizado").count() == 0


def test_ledgers_are_cleaned_in_parts(spark, layered, tmp_path, monkeypatch):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    landed = {name: layers.read_layer(spark, layered[1], name).repartition(3) for name in [*RAW, "bcb_cotacoes"]}
    assert pipeline.land({name: (lambda df=df: df) for name, df in landed.items()}, bronze) == {}
    monkeypatch.setattr(pipeline, "LEDGER_PART", 1)
    wrote = []
    write = layers.write_layer
    monkeypatch.setattr(pipeline, "write_layer", lambda df, folder, name, *a, **o: wrote.append(name) or write(df, folder, name, *a, **o))
    pipeline.run_silver(spark, bronze, silver)
    assert wrote.count("conta_receber_silver") == 3 and wrote.count("cliente_silver") == 1
    for name in ("conta_receber_silver", "conta_pagar_silver", pipeline.QUALITY):
        assert rows(layers.read_layer(spark, silver, name)) == rows(layers.read_layer(spark, layered[2], name)), name

    def breaks(df, folder, name, *args, **options):
        if options.get("add"):
            raise RuntimeError("broken")
        return write(df, folder, name, *args, **options)

    monkeypatch.setattr(pipeline, "write_layer", breaks)
    with pytest.raises(RuntimeError, match="broken"):
        pipeline.run_silver(spark, bronze, silver)
    with pytest.raises(FileNotFoundError):  # not the table that was there, nor a part of the new one
        layers.read_layer(spark, silver, "conta_receber_silver")


def test_parts_of_a_layer_are_all_its_rows(spark, tmp_path):
    df = spark.range(40).select(F.col("id").cast("string").alias("a"), (F.col("id") % 2).cast("string").alias("m")).repartition(4)
    for kind, by in (("parquet", None), ("csv", None), ("parquet", ["m"])):
        layers.write_layer(df, str(tmp_path), "t", kind, partition_by=by)
        parts = layers.read_layer_parts(spark, str(tmp_path), "t", 1)
        assert len(parts) > 1
        assert sorted(sum((rows(p.select("a", F.col("m").cast("string"))) for p in parts), [])) == sorted(rows(df))
        assert len(layers.read_layer_parts(spark, str(tmp_path), "t", 1 << 30)) == 1
        layers.remove_layer(spark, str(tmp_path), "t", kind)


def test_writing_a_layer_leaves_no_shuffle_and_no_setting(spark, tmp_path):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {f for f in files if "/shuffle_" in f and f.endswith(".data")}

    before = shuffles()
    layers.write_layer(spark.range(10_000).withColumn("m", F.col("id") % 3), str(tmp_path), "t", partition_by=["m"], sort_by=["id"])
    until = time.monotonic() + 20
    while shuffles() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffles() - before
    setting = shared._SHUFFLE_CLEANUP
    assert spark.conf.get(setting, None) is None
    spark.conf.set(setting, "false")
    with shared.dropping_shuffles(spark), shared.dropping_shuffles(spark):
        assert spark.conf.get(setting) == "true"
    assert spark.conf.get(setting) == "false"
    spark.conf.unset(setting)


def test_feeds_are_stored_one_after_the_other(spark, tmp_path):
    running, most = [], []

    def feed():
        running.append(1)
        most.append(len(running))
        time.sleep(0.5)
        running.pop()
        return spark.range(3)

    assert pipeline.land({name: feed for name in "abc"}, str(tmp_path)) == {}
    assert most == [1, 1, 1]


def test_landing_reports_failures_and_goes_on(layered):
    assert list(layered[0]) == ["PS_Ausente"]


def test_completed_rates_cover_the_payment_month(spark, layered):
    rates = layers.read_layer(spark, layered[1], "bcb_cotacoes")
    assert rates.count() == 3 * 22  # 10 to 31 January
    assert {r.moeda for r in rates.select("moeda").distinct().collect()} == {"EUR", "USD", "GBP"}


def test_silver_layer(spark, layered):
    assert layers.read_layer(spark, layered[2], "meta_2025_silver").count() == 3
    assert rows(layers.read_layer(spark, layered[2], "categoria_silver")) == [
        ("c1", "VENDA A VISTA", "RECEITA"), ("c2", "FRETES", "DESPESA")]
    ledger = layers.read_layer(spark, layered[2], "conta_receber_silver")
    assert ledger.count() == 200
    got = {r.id_conta: (r.valor_conta, r.valor_conta_brl) for r in ledger.collect()}
    assert got[1] == (101.0, 606.0) and got[2] == (102.0, 510.0) and got[0] == (100.0, 100.0)
    assert got[3] == (103.0, 103.0) and got[4] == (104.0, 104.0)
    assert got[25] == (125.0, 125.0)  # foreign but not paid yet


def test_gold_layer_has_the_declared_tables(layered):
    star = layered[3]
    for name, df in star.tables().items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in GOLD[name]], name
    assert star.fato_conta_receber.count() == 200
    assert rows(star.fato_conta_pagar.select("id_conta_pagar", "valor_conta")) == [(1, 12.0)]
    assert star.dim_cliente.count() == 24
    assert star.dim_data.where(F.col("data_calendario") == date(2025, 1, 15)).count() == 1


def test_segment_layer(spark, layered):
    comparison = layers.read_layer(spark, layered[4], "model_comparison")
    assert comparison.count() == 14
    segmented = layers.read_layer(spark, layered[4], "cliente_clusterizado")
    assert segmented.count() == 24 and segmented.where("cluster is null").count() == 0
    best = comparison.orderBy(F.desc("ranking_score"), "model_name").first().model_name
    assert {r.modelo_vencedor for r in segmented.select("modelo_vencedor").collect()} == {best}


def test_jobs_at_the_same_time_remove_their_own_tables_only(spark):
    from threading import Event

    from ledgermill.sources.shared import materialise, removing_tables, side_by_side

    inside, over = Event(), Event()

    def short():
        inside.wait(60)
        with removing_tables(spark):
            table = materialise(spark.range(3).toDF("a"))
            assert table.count() == 3
        over.set()
        return table.inputFiles()

    def long():
        with removing_tables(spark):
            first = materialise(spark.range(5).toDF("a"))
            inner = side_by_side(lambda: materialise(spark.range(7).toDF("a")))[0]
            inside.set()
            over.wait(60)
            assert first.count() == 5 and inner.count() == 7
        return first.inputFiles() + inner.inputFiles()

    import os
    for files in side_by_side(short, long):
        assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_loads_are_seen_whole_or_not_at_all(spark, tmp_path):
    from ledgermill.sources.loads import LoadTable

    table = LoadTable(spark, str(tmp_path), "t")
    frame = lambda *r: spark.createDataFrame(list(r), "k bigint, m string, v bigint")
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.append(frame((1, "a", 1), (2, "b", 1)), ["k"], "one")
    assert not table.append(frame((9, "z", 9)), ["k"], "one")
    assert table.append(frame((2, "b", 2), (3, "c", 2), (None, "c", 2)), ["k"], "two")
    with pytest.raises(Exception, match="broken"):
        table.append(frame((7, "q", 7)).selectExpr("k", "m", "cast(raise_error('broken') as bigint) as v"), ["k"], "three")
    held = lambda: sorted(((r.k or 0), r.m, r.v, r.carga) for r in table.read().collect())
    assert held() == [(0, "c", 2, "two"), (1, "a", 1, "one"), (2, "b", 1, "one"), (3, "c", 2, "two")]
    assert table.replace(frame((4, "c", 3), (5, None, 3)), "four", "m")
    assert held() == [(1, "a", 1, "one"), (2, "b", 1, "one"), (4, "c", 3, "four"), (5, None, 3, "four")]
    assert table.append(frame((6, "c", 4)), ["k"], "three")  # the load that broke, run again
    assert len(held()) == 5 and table.compact("all") and {r[3] for r in held()} == {"all"} and len(held()) == 5
    assert table.replace(frame((8, "x", 5)), "anew") and held() == [(8, "x", 5, "anew")]


def test_two_feeds_of_one_name_are_an_error(spark, tmp_path):
    from ledgermill.plans import pipeline

    for name in ("A.csv", "A.json"):
        (tmp_path / name).write_text("x")
    with pytest.raises(ValueError, match="A"):
        pipeline.raw_readers(spark, str(tmp_path))

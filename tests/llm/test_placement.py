import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import packing, sharding


def turns(names, slots):
    """The table by whole preference lists."""
    from hashlib import md5
    orders = []
    for name in names:
        d = md5(name.encode()).digest()
        a, b = int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:], "big") % (slots - 1) + 1
        orders.append([(a + b * k) % slots for k in range(slots)])
    holder, turn = {}, 0
    while len(holder) < slots:
        for shard, order in enumerate(orders):
            if len(holder) < slots:
                holder[next(s for s in order if s not in holder)] = shard
    return [holder[s] for s in range(slots)]


def test_table_is_filled_by_turns_evenly_and_changes_little():
    names = [f"n{i}" for i in range(7)]
    assert sharding.lookup_table(names, 101).tolist() == turns(names, 101)
    table = sharding.lookup_table(names, 10_007)
    sizes = np.bincount(table)
    assert sizes.max() - sizes.min() <= 1
    without = sharding.lookup_table(names[:-1], 10_007)
    stayed = table != 6
    assert (without[stayed] == table[stayed]).mean() > 0.75
    for wrong in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(wrong, 101)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 100)


def test_rows_go_to_the_shard_of_their_slot(spark, tmp_path):
    rows = [(i, f"t{i}", 5, "old") for i in range(300)] + [(None, "x", 1, "old"), (7, None, 1, "old"), (7, None, 1, "old")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, slot int, shard string")
    names = [f"s{i}" for i in range(5)]
    placed = sharding.assign_shards(table, names, slots=1009).collect()
    holder = sharding.lookup_table(names, 1009)
    assert len(placed) == len(rows)
    slot = lambda key: duckdb.sql(f"SELECT ('0x' || substr(md5('{key}'), 1, 15))::BIGINT % 1009").fetchall()[0][0]
    for r in placed[::25] + [x for x in placed if x.doc_id is None]:
        assert r.slot == slot("" if r.doc_id is None else r.doc_id) and r.shard == names[holder[r.slot]]
    assert sharding.assign_shards(table.where("false"), names, slots=1009).collect() == []
    sharding.write_shards(table, f"{tmp_path}/out", names, slots=1009)
    read = spark.read.parquet(f"{tmp_path}/out")
    assert read.count() == len(rows) and read.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).where("n > 1").isEmpty()


def plain(sizes, sources, clusters, capacity):
    bins = []
    where = []
    for size, source, cluster in zip(sizes, sources, clusters):
        fits = [(capacity - sum(s for s, _, _ in b), i) for i, b in enumerate(bins)
                if capacity - sum(s for s, _, _ in b) >= size
                and not any(size and s and (source >= 0 and source == x or cluster >= 0 and cluster == y) for s, x, y in b)]
        i = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([])
        where.append(i)
        bins[i].append((size, source, cluster))
    return where


def test_best_fit_equals_a_search_of_all_bins():
    rng = random.Random(1)
    for _ in range(20):
        n = 120
        sizes = sorted((rng.randrange(0, 60) for _ in range(n)), reverse=True)
        sources = [0 if rng.random() < 0.35 else rng.randrange(-1, 9) for _ in range(n)]
        clusters = [rng.choice([-1, -1, 0, 1, 2]) for _ in range(n)]
        assert packing.best_fit(sizes, sources, clusters, 100)[0] == plain(sizes, sources, clusters, 100)


def test_packing_keeps_all_words_and_all_limits(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 250)), "hot" if rng.random() < 0.4 else f"s{rng.randrange(5)}", i) for i in range(400)]
    rows += [(900, "same words here", "a", 0), (901, "same words here", "b", 0), (902, None, None, 0), (903, "", "hot", 0),
             (None, "x y", None, 0), (None, None, None, 0), (904, "x " * 20_000, "hot", 0), (904, "x " * 20_000, "hot", 0), (905, "q " * 100, None, 0)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string, bin int")
    out = packing.pack(table, capacity=100, group_rows=64).toPandas()
    assert out.words.sum() == sum(len((r[1] or "").split()) for r in rows)
    assert out.groupby("bin").words.sum().max() <= 100
    real = out[out.words > 0]
    assert not real.duplicated(["bin", "place"]).any()
    rest = real[real.words < 100]
    assert not rest.dropna(subset=["source"]).duplicated(["bin", "source"]).any() and not rest.duplicated(["bin", "cluster"]).any()
    for _, own in real.groupby("bin"):
        own = own.sort_values("place")
        assert (own.place.to_numpy() == np.concatenate([[0], own.words.cumsum().to_numpy()[:-1]])).all()
    for doc, text in ((904, 40_000), (905, 100), (902, 0)):
        assert out[out.doc_id == doc].words.sum() == text
    assert {902, 903} <= set(out.doc_id.dropna())
    assert packing.pack(table.where("false")).collect() == []


def test_word_counts(spark):
    texts = ["a b", " a\t\tb\nc ", "", None, "   ", "x"]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in table.select(packing.word_count(F.col("text"))).collect()] == [2, 3, 0, 0, 0, 1]


def test_rows_of_one_id_do_not_share_a_group(spark):
    rows = [(7, "a b c", "s")] * 600 + [(None, "", None)] * 600 + [(8, f"w{i} x", "s") for i in range(600)] + [(i, "y z", "t") for i in range(100, 700)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = packing.pack(table, capacity=100, group_rows=60).toPandas()
    assert len(out) == len(rows) and out.words.sum() == 600 * (3 + 2 + 2)
    assert out.fillna({"doc_id": -1}).groupby("doc_id").size().loc[[7, -1, 8]].tolist() == [600] * 3
    assert (out["bin"] // (1 << 32)).value_counts().max() < 2.5 * 60

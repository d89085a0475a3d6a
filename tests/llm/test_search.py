import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgermill.llm import ranked, topk

VECTORS = "vec_id bigint, embedding array<double>, label int, query bigint, vector string, score int, rank int"
DOCS = "doc_id bigint, text string, item bigint, n int, terms string, rank int, score string"
ITEMS = "item_id bigint, text string, item string, doc_id int, terms int"


def nearest(rows, top):
    """Every query against every row."""
    use = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) and abs(1024 * x) < 2 ** 63 for x in v):
            use.append((i, tuple(math.floor(1024 * x) for x in v)))
    out = []
    for q in sorted({r for r in use if r[0] % 100 == 0}):
        scores = sorted((-sum(a * b for a, b in zip(q[1], v)), i) for i, v in use if i != q[0] and len(v) == len(q[1]))
        out += [(q[0], k + 1, i, min(-s, 2 ** 63 - 1)) for k, (s, i) in enumerate(scores[:top])]
    return sorted(out)


def found(spark, rows, top=10):
    table = spark.createDataFrame([(*r, 1, 2, "v", 3, 4) for r in rows], VECTORS)
    result = topk.top_neighbours(table, table.where("vec_id % 100 = 0"), top=top)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in result.collect())


def clustered(seed, n, width):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    return [(25 * i, (centres[i % 6] + 0.2 * rng.normal(size=width)).tolist()) for i in range(n)]


def test_neighbours_equal_brute_force(spark):
    rows = clustered(1, 300, 8)
    assert found(spark, rows) == nearest(rows, 10)


def test_ties_copies_and_odd_vectors(spark):
    rows = clustered(2, 40, 4)
    rows += [(10_000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(300)]  # copies
    rows += [(0, rows[0][1]), (100, [1.0, 0.0, 0.0, 0.0]), (100, [0.0, 1.0, 0.0, 0.0])]  # repeated ids
    rows += [(200, None), (300, [None, 1.0, 1.0, 1.0]), (400, [float("nan"), 1.0, 1.0, 1.0]), (None, [9.0, 9.0, 9.0, 9.0]),
             (500, [float("inf"), 0.0, 0.0, 0.0]), (600, []), (601, []), (700, [1.0]), (701, [2.0]), (702, [-2.0]),
             (800, [1e17, 0.0, 0.0, 0.0]), (20_000, [2.0 ** 40] * 4), (20_001, [2.0 ** 50, -1.0, 3.0, 0.0])]
    got = found(spark, rows)
    assert [r for r in got if r[0] not in (20_000,)] == [r for r in nearest(rows, 10) if r[0] not in (20_000,)]
    # Beyond a long the nearest long stands.
    assert [r for r in got if r[0] == 20_000][0] == (20_000, 1, 20_001, 2 ** 63 - 1)


def test_no_vectors_or_queries(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0]), (2, [2.0])]) == []
    assert found(spark, [(100, [1.0])]) == []


def test_blocks_of_queries_and_rounds_change_nothing(spark, monkeypatch):
    rows = clustered(3, 400, 4)
    monkeypatch.setattr(topk, "QUERY_VALUES", 40)
    monkeypatch.setattr(topk, "FIRST_ROUND_ROWS", 4)
    monkeypatch.setattr(topk, "ROUND_GROWTH", 4)
    assert found(spark, rows, 3) == nearest(rows, 3)


def test_trees_within_a_task_pass_on_the_last_place(monkeypatch):
    monkeypatch.setattr(topk, "SHARD_VALUES", 1024 * 8)
    rows = clustered(4, 3000, 8)
    ids = np.array([i for i, _ in rows])
    whole = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64)
    asked = np.flatnonzero(ids % 100 == 0)
    block = {8: (ids[asked], ids[asked], whole[asked], np.full(len(asked), topk._LEAST), np.full(len(asked), topk._MOST))}
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(whole.tolist(), pa.list_(pa.int64()))], names=["vec_id", "vector"])
    leaves = []
    add = topk.Answers.add
    monkeypatch.setattr(topk.Answers, "add", lambda self, q, s, i: (leaves.append(len(q)), add(self, q, s, i)))
    got = [r for b in topk._searched(iter([batch]), block, 5) for r in zip(*(c.to_pylist() for c in b.columns))]
    scores = whole[asked] @ whole.T
    for q, row in zip(ids[asked], scores):
        order = sorted((-s, i) for s, i in zip(row.tolist(), ids.tolist()) if i != q)[:5]
        assert sorted((-s, i) for place, i, s in got if place == q) == order
    # Boxes rule out most of the leaves: a query looks into few of the trees' leaves.
    assert sum(leaves) < 0.6 * len(asked) * len(ids) / topk.LEAF_ROWS


def best_documents(docs, items, top):
    """Every item against every document, term by term."""
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    read = [(d, terms(t)) for d, t in docs]
    n_docs, length = sum(1 for _, t in read if t), sum(len(t) for _, t in read)
    out = []
    for item, text in sorted(set(items), key=repr):
        scores = []
        for d, t in read:
            m, score = (50 + (50 * len(t) * n_docs) // length if length else 0), 0
            for term in set(terms(text)):
                tf = t.count(term)
                if tf:
                    df = sum(term in x for _, x in read)
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, d if d is not None else 1 << 63, d))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scores, key=lambda x: x[:2])[:top])]
    return sorted(out, key=repr)


def searched(spark, docs, items, top=ranked.TOP):
    table = spark.createDataFrame([(*d, 1, 2, "t", 3, "s") for d in docs], DOCS)
    asked = spark.createDataFrame([(*i, "x", 1, 2) for i in items], ITEMS)
    result = ranked.ranked_search(table, asked, top=top)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in result.collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    pool = [f"w{min(int(rng.expovariate(0.1)), 60)}" for _ in range(400)] + ["Straße", "ÀB", "x9"]
    say = lambda k: " ".join(rng.choice(pool) + rng.choice(["", ",", "."]) for _ in range(k))
    return [(i, say(rng.randrange(0, 40))) for i in range(n)], [(i, say(rng.randrange(1, 14))) for i in range(12)]


def test_ranking_equals_brute_force(spark):
    docs, items = corpus(5, 150)
    docs += [(7, docs[7][1]), (8, "w1 w2"), (None, docs[9][1]), (None, None), (500, None), (501, ""), (502, " .,"),
             (503, "w3 " * 30_000), (504, docs[9][1]), (505, docs[9][1].upper())]
    items += [(3, "w5 w6"), (4, None), (5, ""), (None, "w1 W2"), (20, "nowhere"), (21, "w1 w1 w1"), items[0],
              (22, " ".join(f"w{i}" for i in range(200)))]  # a mask of several words
    assert searched(spark, docs, items) == best_documents(docs, items, ranked.TOP)
    assert searched(spark, docs, items, top=3) == best_documents(docs, items, 3)


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    docs, items = corpus(6, 60)
    monkeypatch.setattr(ranked, "ITEM_BLOCK", 5)
    assert searched(spark, docs, items, 4) == best_documents(docs, items, 4)
    monkeypatch.setattr(ranked, "TERM_BLOCK", 9)
    assert searched(spark, docs, items, 4) == best_documents(docs, items, 4)


@pytest.mark.parametrize("docs, items", [([], [(1, "a b")]), ([(1, "a b")], []), ([], []), ([(1, None)], [(1, "a")])])
def test_nothing_to_rank(spark, docs, items):
    assert searched(spark, docs, items) == []


def test_masks_are_worked_on_until_none_can_win(monkeypatch):
    """Few of the documents are scored, and the answer is that of scoring all."""
    rng = np.random.default_rng(7)
    n, terms = 4096, 90
    held = rng.random((n, terms)) < np.linspace(0.02, 0.5, terms)
    doc, term = np.nonzero(held)
    items = ranked.Items(np.arange(1), [np.arange(terms)], np.arange(terms, dtype=np.uint64),
                         rng.integers(100, 5000, terms), n, len(doc))
    best, scored = [ranked._Best(10)], []
    add = ranked._Best.add
    monkeypatch.setattr(ranked._Best, "add", lambda self, s, i: (scored.append(len(s)), add(self, s, i)))
    m = np.full(n, 100)
    ranked._search_block(np.arange(n), m, doc, term, np.ones(len(doc), np.int64), items, best)
    all_scores = held @ (items.weights * (10 ** 9 // 3000))
    order = np.lexsort((np.arange(n), -all_scores))[:10]
    assert best[0].ids.tolist() == order.tolist() and best[0].scores.tolist() == all_scores[order].tolist()
    assert sum(scored) < n / 10

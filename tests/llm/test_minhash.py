import random

import numpy as np

from ledgermill.llm import minhash
from ledgermill.llm.components import connected_components

SCHEMA = "doc_id bigint, text string, band string, component int, first string, text_a string"


def shingles(text, width):
    words = [w.lower() for w in (text or "").split()]
    if not words:
        return set()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(docs, width, percent):
    ids = sorted({d for d, _ in docs if d is not None})
    component = {d: d for d in ids}
    links = [(a, b) for i, (a, x) in enumerate(docs) for b, y in docs[:i]
             if a is not None and b is not None and a != b and (s := shingles(x, width)) and (t := shingles(y, width))
             and 100 * len(s & t) >= percent * len(s | t)]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(component[a], component[b])
            changed |= component[a] != low or component[b] != low
            component[a] = component[b] = low
    return sorted(((d, len(shingles(t, width)), component.get(d), component.get(d) == d or d is None) for d, t in docs), key=repr)


def found(spark, docs, width, percent=80):
    table = spark.createDataFrame([(*d, "b", 1, "f", "t") for d in docs], SCHEMA)
    return sorted((tuple(r) for r in minhash.near_duplicates(table, width=width, percent=percent).collect()), key=repr)


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else f"new{rng.randrange(10 ** 6)}" for w in words)


def test_sketch_fills_and_estimates_similarity():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 100, 5000):
        elements = rng.integers(0, 1 << 63, size).astype(np.uint64)
        whole = minhash.sketch(elements)
        assert not (whole == np.uint64((1 << 64) - 1)).any()
        assert (whole == minhash.sketch(rng.permutation(elements))).all()
    for common in (200, 600, 900):
        shared, own = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (common, 1000 - common))
        other = rng.integers(0, 1 << 63, 1000 - common).astype(np.uint64)
        alike = (minhash.sketch(np.concatenate([shared, own])) == minhash.sketch(np.concatenate([shared, other]))).mean()
        assert abs(alike - common / (2000 - common)) < 0.09


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    docs = []
    for group in range(12):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(12, 90))]
        docs += [(len(docs) + i, edited(rng, words, rng.choice([0, 0.01, 0.03, 0.05, 0.08]))) for i in range(10)]
    docs += [(900, None), (901, ""), (902, " \t\n"), (903, "a b"), (904, "A  b"), (905, "a b c"), (906, "x" * 200_000),
             (None, docs[0][1]), (None, None), (907, docs[5][1]), (907, docs[5][1]), (908, docs[15][1]), (908, docs[40][1])]
    for width in (4, 5):
        assert found(spark, docs, width) == brute(docs, width, 80)


def test_members_of_mixed_buckets_are_all_compared(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE_ROWS", 8)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(160)]
    docs = [(i, edited(rng, words, rng.choice([0.02, 0.04, 0.06, 0.08]))) for i in range(60)]
    expected = brute(docs, 3, 80)
    assert 1 < len({r[2] for r in expected}) < 60
    assert found(spark, docs, 3) == expected


def test_no_rows(spark):
    assert found(spark, [], 5) == []


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 240)] + [(300, 301), (301, 302), (302, 300)]
    links += [(5, 5), (None, 4), (4, None), (300, 301), (239, 1)]
    result = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert result == ({i: 100 for i in range(100, 161)} | {i: 1 for i in (1, 7, *range(200, 240))} | {i: 300 for i in (300, 301, 302)})
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []

import random
import re
import zlib
from collections import Counter

import numpy as np

from ledgermill.llm import spelling

DOCS = "doc_id bigint, text string, word string, n int, id bigint, form string, run string"


def one_edit(a, b):
    """Whether one inserted, deleted or replaced letter makes a to b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def variants(docs):
    """All words against all."""
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in counts if x != w and one_edit(w, x)] for w in counts}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n, len(near[w]), counts[form[w]] if form[w] else 0) for w, n in counts.items())


def found(spark, docs):
    table = spark.createDataFrame([(*d, "w", 1, 2, "f", "r") for d in docs], DOCS)
    result = spelling.spelling_variants(table)
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in result.collect())


def edited(rng, word):
    i, c = rng.randrange(len(word) + 1), rng.choice("abcéß")
    return rng.choice([word[:i] + c + word[i:], word[:max(0, i - 1)] + word[i:], word[:max(0, i - 1)] + c + word[i:]])


def test_variants_equal_brute_force(spark):
    rng = random.Random(1)
    base = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randrange(6, 11))) for _ in range(25)]
    pool = [w for w in base for _ in range(30)] + [edited(rng, w) for w in base for _ in range(12)]
    pool += [edited(rng, edited(rng, w)) for w in base for _ in range(4)]
    docs = [(i, " ".join(rng.choice(pool) + rng.choice(["", ",", "9", "-"]) for _ in range(rng.randrange(0, 60)))) for i in range(200)]
    docs += [(3, docs[3][1]), (None, docs[4][1]), (300, None), (301, ""), (302, "1 2 3"), (303, docs[5][1].upper())]
    got = found(spark, docs)
    assert got == variants(docs) and any(r[1] for r in got) and any(r[4] > 3 for r in got)


def test_ties_chains_and_short_words(spark):
    say = lambda w, n: [(k, w) for k in range(1000, 1000 + n)]
    docs = say("aaaaaaaa", 400) + say("aaaaaaab", 30) + say("aaaaaabb", 2) + say("aaaaaa", 9)
    docs += say("zwilling", 2) + say("zwillinb", 20) + say("zwillinc", 20) + say("Übergang", 3) + say("übergang", 30)
    assert found(spark, docs) == variants(docs)


def test_words_of_any_length(spark):
    long = "abcdefgh" * 12_000
    docs = [(1, long), (2, long), (3, long + "x"), (4, long + "x"), (5, "short"), (6, f"{long[:50]}é{long[51:]} " * 30)]
    got = {(len(w), n_near, len(root)) for w, _, root, _, n_near, _ in found(spark, docs)}
    assert got == {(96_000, 2, 96_000), (96_001, 1, 96_001), (96_000, 1, 96_000)}


def test_no_words(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, "one two")]) == []


def test_neighbourhoods_are_whole_and_hold_each_word_once():
    rng = random.Random(2)

    def plain(w):
        s = [chr(48 + i) for i in range(spelling.SYMBOLS)]
        return {w} | {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in s} | {
            w[:i] + c + w[i:] for i in range(len(w) + 1) for c in s}

    def own(w):
        return int(next(spelling.neighbourhood(np.array([[ord(c) - 48 for c in w]], np.uint8)))[1][0])

    for size in (1, 2, 5, 9):
        words = ["".join(rng.choice("00012347") for _ in range(size)) for _ in range(6)]
        keys = {w: [] for w in range(len(words))}
        for rows, hashes in spelling.neighbourhood(np.array([[ord(c) - 48 for c in w] for w in words], np.uint8)):
            for row, h in zip(rows.tolist(), hashes.tolist()):
                keys[row].append(h)
        for row, word in enumerate(words):
            assert sorted(keys[row]) == sorted(own(w) if w else keys[row][0] for w in plain(word) if w) or size == 1
            assert len(keys[row]) == len(plain(word))

import random

import numpy as np

from ledgermill.llm import language, toxicity

SYLLABLES = {"aa": ["ka", "lo", "mi", "ta"], "bb": ["str", "wen", "ool", "gr"], "cc": ["éa", "oui", "eux", "çon"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        words = sentence(rng, rng.choice(list(SYLLABLES)), rng.randrange(20, 80)).split()
        toxic = int(rng.random() < 0.2)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "Scum!", "WORTHLESS"]))
        rows.append((i, " ".join(words), toxic, "x"))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int, score string")
    model = toxicity.fit(table.where("doc_id % 3 != 0"))
    scores = {r.doc_id: r.score for r in toxicity.score(table, model).collect()}
    held = [r for r in rows if r[0] % 3 == 0]
    assert np.mean([(scores[i] >= 0.3) == bool(y) for i, _, y, _ in held]) > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "idiot " * 3), (2, ""), (3, "a"), (4, "idiot " + "x" * 300_000)], "doc_id bigint, text string")
    result = [tuple(r) for r in toxicity.score(odd, model).collect()]
    assert len(result) == 6 and all(0 <= s <= 1 for _, s in result)
    assert result[0][1] == result[1][1] == result[3][1] < 0.3 < result[2][1] and result[5][1] > 0.3


def test_toxicity_equals_a_plain_recount(spark):
    rng = random.Random(7)
    rows = []
    for i in range(160):
        words = sentence(rng, rng.choice(["aa", "bb"]), rng.randrange(0, 12)).split()
        toxic = int(i % 4 == 0)
        rows.append((i, " ".join([*words, *["Idiot!", "you scum"][: toxic * rng.randrange(3)], *["thanks"][: rng.randrange(2)]]), toxic))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(table)

    def bucket(gram):
        value = sum(ord(c) * int(toxicity._PLACES[len(gram)][j]) for j, c in enumerate(gram)) % 2**32
        value = (value ^ value >> 15) * 0x2C1B3C6D % 2**32
        return value >> 32 - toxicity._BITS

    def grams(text):
        plain = "".join(c if c.isalpha() else "\0" for c in f"\0{text.lower()}\0")
        return {bucket(plain[i:i + n]) for n in (3, 4, 5) for i in range(len(plain) - n + 1)}

    have = [grams(text) for _, text, _ in rows]
    labels = np.array([y for _, _, y in rows], float)
    ones, total = labels.sum(), len(rows)
    scale = {}
    for gram in set().union(*have):
        toxic = sum(gram in g for g, y in zip(have, labels) if y)
        seen = sum(gram in g for g in have)
        ratio = np.log((toxic + 1) / (ones + 2)) - np.log((seen - toxic + 1) / (total - ones + 2))
        expected = seen * ones / total
        spread = np.sqrt(expected * (1 - ones / total) * max(1 - seen / total, 1e-9)) + 1e-9
        if seen >= 5 and abs(toxic - expected) >= 5 * spread and abs(ratio) >= 0.4:
            scale[gram] = ratio
    assert scale and set(np.flatnonzero(model.weights)) == set(scale)
    # Where the slope of the penalised loss vanishes, its weights are the only best ones. The bias is still on its way: it
    # moves at the rate that suits much larger inputs.
    chosen = sorted(scale)
    inputs = np.array([[scale[g] * (g in own) for g in chosen] for own in have])
    learned = model.weights[chosen] / np.array([scale[g] for g in chosen])
    logits = inputs @ learned + model.bias
    gap = 1 / (1 + np.exp(-logits)) - labels
    assert np.abs(inputs.T @ gap / total + 1e-4 * learned).max() < 1e-4 and abs(gap.mean()) < 1e-2
    scores = {r.doc_id: r.score for r in toxicity.score(table, model).collect()}
    assert np.allclose([scores[i] for i, _, _ in rows], 1 / (1 + np.exp(-logits)), atol=1e-6)


def test_toxicity_without_both_classes(spark):
    table = spark.createDataFrame([(1, "a", 0), (2, None, 0), (3, "b", None), (4, "c", 7)], "doc_id bigint, text string, toxic int")
    model = toxicity.fit(table)
    assert all(r.score < 0.3 for r in toxicity.score(table, model).collect())
    empty = table.where("false")
    assert toxicity.score(empty, toxicity.fit(empty)).collect() == []


def test_fit_does_not_depend_on_partitions(spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng, "aa", 20) + (" idiot" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    one, other = (toxicity.fit(table.repartition(n), fit_rows=200) for n in (1, 7))
    assert np.allclose(one.weights, other.weights, atol=1e-6) and abs(one.bias - other.bias) < 1e-6


def fitted(spark, rows):
    return language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))


def test_language_of_plain_and_switching_texts(spark):
    rng = random.Random(3)
    rows = [(i, sentence(rng, lang, 40), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    model = fitted(spark, rows + [(1000, "zz", None), (None, "zz", "dd"), (1001, None, "aa"), (1002, "12", "bb")])
    assert model.labels == ["aa", "bb", "cc"]
    assert all(model.transitions[i, i] > model.transitions[i].mean() for i in range(3))
    fresh = [(i, sentence(rng, lang, 30), lang) for i, lang in enumerate(list(SYLLABLES) * 20)]
    mixed = [(100 + i, sentence(rng, "aa", 10 + 30 * (i % 2)) + ". " + sentence(rng, "cc", 25), "aa" if i % 2 else "cc") for i in range(10)]
    odd = [(200, None, "und"), (201, "", "und"), (202, "12 !? — 3", "und"), (200, None, "und"), (None, sentence(rng, "bb", 5), "bb"),
           (203, sentence(rng, "cc", 30_000), "cc")]
    table = spark.createDataFrame(fresh + mixed + odd, "doc_id bigint, text string, lang string")
    got = language.predict(table, model, keep=("lang",)).collect()
    assert len(got) == len(fresh + mixed + odd)
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.98
    assert all((r.score == 0) == (r.lang_pred == "und") and 0 <= r.score <= 1 for r in got)
    shares = [r.score for r in got if r.doc_id and 100 <= r.doc_id < 110]
    assert all(0.5 < s < 0.85 for s in shares)


def test_language_without_examples(spark):
    table = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    assert [tuple(r) for r in language.predict(table, language.fit(table)).collect()] == [(1, "und", 0.0)]
    assert language.predict(table.where("false"), language.fit(table.where("false"))).collect() == []
    model = fitted(spark, [(1, "abc def", "aa")])
    assert language.predict(table, model).first().lang_pred == "aa"


def test_blocked_marginals_equal_plain_forward_backward():
    rng = np.random.default_rng(5)
    sizes, labels = [1, 3, 0, 64, 65, 200], 3
    first = np.concatenate([[0], np.cumsum(sizes)])
    emissions, pairs = rng.normal(size=(first[-1], labels)) * 2, rng.normal(size=(labels, labels))
    got = language._marginals(emissions, pairs, first)
    for row, (a, b) in enumerate(zip(first[:-1], first[1:])):
        step, pair, n = np.exp(emissions[a:b]), np.exp(pairs), b - a
        ahead, behind = np.ones((n, labels)), np.ones((n, labels))
        for t in range(n):
            ahead[t] = step[t] * (ahead[t - 1] @ pair if t else 1)
            ahead[t] /= ahead[t].sum()
        for t in range(n - 2, -1, -1):
            behind[t] = pair @ (step[t + 1] * behind[t + 1])
            behind[t] /= behind[t].sum()
        both = ahead * behind
        expected = (both / both.sum(1, keepdims=True)).sum(0) if n else np.zeros(labels)
        assert np.allclose(got[row], expected)


def test_samples_are_cut_before_the_driver(spark, monkeypatch):
    from ledgermill.llm import language, pages

    docs = spark.createDataFrame([(1, f"some words of row {i}", "en") for i in range(300)] + [(2, "autres mots", "fr")],
                                 "doc_id bigint, text string, lang string")
    html = spark.createDataFrame([(1, f"<html><body><p>page {i}</p></body></html>") for i in range(300)], "page_id bigint, html string")
    brought, collect = [], type(docs).toPandas
    monkeypatch.setattr(type(docs), "toPandas", lambda df: brought.append(frame := collect(df)) or frame)
    language.fit(docs, fit_rows=20, rounds=2)
    pages.fit(html, fit_pages=20, rounds=1)
    assert [len(frame) for frame in brought] == [20, 20]
    assert brought[1]["html"].tolist() == sorted(r.html for r in html.collect())[:20]


def test_marks_alone_are_no_language(spark):
    docs = [(i, f"{w} bonjour monde {w}" if i % 2 else f"hello world {w}", "fr" if i % 2 else "en") for i, w in enumerate("abcdefgh" * 4)]
    model = language.fit(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"))
    odd = spark.createDataFrame([(1, "\u0301\u0302 \u0303"), (2, "hello e\u0301 world"), (3, "12 \u0301")], "doc_id bigint, text string")
    assert [r.lang_pred for r in language.predict(odd, model).orderBy("doc_id").collect()] == ["und", "en", "und"]

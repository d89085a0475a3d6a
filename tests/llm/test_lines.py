import random

from ledgermill.llm import lines

SCHEMA = "doc_id bigint, text string, run string, start int, mark bigint, text_b string"


def brute(docs, run_words):
    """Lines that lie in a later copy of any run of lines with enough words."""
    order = sorted({(d if d is not None else 1 << 63, t or "") for d, t in docs}, key=lambda x: x[0])
    found, first = {}, {}
    for key in order:
        own = [(i, x.strip()) for i, x in enumerate(key[1].split("\n")) if x.strip()]
        gone = set()
        for a in range(len(own)):
            total = 0
            for b in range(a, len(own)):
                total += len(own[b][1].split())
                if total >= run_words:
                    run = tuple(x for _, x in own[a:b + 1])
                    seen = first.setdefault(run, (key, own[a][0], own[b][0]))
                    if seen[0] != key or own[a][0] > seen[2]:
                        gone.update(range(own[a][0], own[b][0] + 1))
        found[key] = gone
    out = []
    for d, t in docs:
        gone = found[(d if d is not None else 1 << 63, t or "")]
        left = t if not gone else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
        out.append((d, left, 0 if t is None else len(t.split("\n")), len(gone)))
    return sorted(out, key=repr)


def found(spark, docs, run_words):
    table = spark.createDataFrame([(*d, "r", 1, 2, "t") for d in docs], SCHEMA)
    result = lines.without_repeated_runs(table, run_words=run_words)
    assert result.columns == [*table.columns, "lines_before", "lines_removed"]
    return sorted(((r.doc_id, r.text, r.lines_before, r.lines_removed) for r in result.collect()), key=repr)


def test_removal_equals_brute_force(spark):
    rng = random.Random(1)
    pool = [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(1, 9))) for _ in range(12)]
    docs = [(i, "\n".join(rng.choice([*pool, "", "  "]) for _ in range(rng.randrange(0, 14)))) for i in range(80)]
    docs += [(3, docs[3][1]), (100, None), (100, None), (101, ""), (102, "\n\n"), (None, docs[7][1]), (103, docs[8][1]),
             (104, "\n".join(["same same same same same"] * 9)), (105, "long " * 50_000), (106, "long " * 50_000)]
    for run_words in (5, 12):
        assert found(spark, docs, run_words) == brute(docs, run_words)


def test_short_lines_and_clean_documents_stay(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(1, f"head\n{passage}\ntail"), (2, f"other\n{passage}"), (3, "head\ntail"), (4, "clean text")]
    assert found(spark, docs, lines.RUN_WORDS) == [
        (1, docs[0][1], 3, 0), (2, "other", 2, 1), (3, "head\ntail", 2, 0), (4, "clean text", 1, 0)]


def test_no_rows(spark):
    assert found(spark, [], 50) == []


def test_every_long_run_bears_its_fingerprint():
    rng = random.Random(2)
    run = [" ".join(["x"] * rng.randrange(1, 5)) + f" {i}" for i in range(8)]
    size = sum(len(x.split()) for x in run)
    marks = []
    for k in range(6):
        _, hashes, sizes = lines.read_lines("\n".join([f"a{k}"] * k + run + [f"b{k}"] * 3))
        marks.append({hashes[mark] for _, mark in lines.windows(hashes, sizes, size)})
    assert set.intersection(*marks)


def test_every_run_lies_around_its_fingerprint():
    rng = random.Random(5)
    for _ in range(300):
        sizes = [rng.choice([1, 2, 3, 9]) for _ in range(rng.randrange(0, 12))]
        hashes = [rng.randrange(4) for _ in sizes]
        for begin, end, mark in lines.extended(sizes, lines.windows(hashes, sizes, 7), 7):
            assert begin <= mark <= end and sum(sizes[begin:end + 1]) >= 7


def test_last_lines_of_a_passage_go(spark):
    say = lambda n, k: " ".join(f"{n}w{i}" for i in range(k))
    one, two = [say("a", 60), say("b", 20)], [say("c", 25), say("d", 25), say("e", 3), say("f", 4)]
    docs = [(1, "\n".join(["x", *one, "y"])), (2, "\n".join(["z", *one])), (3, "\n".join(two)), (4, "\n".join(["q", *two, "r"]))]
    assert found(spark, docs, lines.RUN_WORDS) == [(1, docs[0][1], 4, 0), (2, "z", 3, 2), (3, docs[2][1], 4, 0), (4, "q\nr", 6, 4)]


def test_a_match_is_held_against_every_earlier_passage(spark):
    """The last line is repeated from a document that is not the first to hold the passage before it."""
    say = lambda n, k: " ".join(f"{n}w{i}" for i in range(k))
    docs = [(1, f"{say('a', 55)}\nother"), (2, f"{say('a', 55)}\n{say('b', 5)}"), (3, f"{say('a', 55)}\n{say('b', 5)}\nend")]
    assert [r[3] for r in found(spark, docs, lines.RUN_WORDS)] == [0, 1, 2]


def test_hot_lines_are_joined_alike(spark, monkeypatch):
    rng = random.Random(3)
    pool = [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(1, 9))) for _ in range(9)]
    docs = [(i, "\n".join(rng.choice([*pool, "", " "]) for _ in range(rng.randrange(0, 14)))) for i in range(60)]
    for share in (0.0, 0.02, 1.0):
        monkeypatch.setattr(lines, "HOT_SHARE", share)
        assert found(spark, docs, 5) == brute(docs, 5)


def test_columns_named_as_the_counts_give_way(spark):
    table = spark.createDataFrame([(1, "a", "x", "y")], "doc_id bigint, text string, lines_before string, lines_removed string")
    result = lines.without_repeated_runs(table)
    assert result.columns == ["doc_id", "text", "lines_before", "lines_removed"] and result.first()[2:] == (1, 0)

import re

from ledgermill.llm import decontaminate, licenses

ITEM = ("Last week Tom Miller bought 12 boxes of 3.5 kg each for the new shop in town, and later he sold 4 of them. "
        "How many kilograms did Tom Miller keep in the end?")
OTHER = "the quick brown fox jumps over the lazy dog while seven small birds watch from a very old tree"


def hits(spark, docs, items, **options):
    table = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id bigint, text string, item_id int, row string")
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id bigint, text string, doc_id string")
    return {r.doc_id: (r.contaminated, r.item_id, r.n_items) for r in decontaminate.contamination(table, bench, **options).collect()}


def test_copies_and_questions_with_new_values_are_found(spark):
    renamed = ITEM.replace("Tom Miller", "Ann Lee").replace("12", "40").replace("3.5 kg", "2 lb".replace("lb", "g")).replace(" 4 ", " 9 ")
    mixed = ITEM.replace("did Tom Miller", "did Ann Lee")
    docs = [(1, "Before it. " + ITEM + " After it."), (2, "x y\n" + renamed), (3, mixed), (4, "nothing of this kind at all, only words."),
            (5, None), (6, ""), (7, OTHER.upper()), (8, " ".join(OTHER.split()[:9])), (9, f"{ITEM} {OTHER}"), (1, "Before it. " + ITEM + " After it."),
            (None, OTHER), (10, OTHER + " " + "z " * 50_000), (11, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15")]
    items = [(1, ITEM), (2, OTHER), (3, "too short"), (4, None), (2, OTHER), (5, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16")]
    for limit in (10 ** 6, 0):
        got = hits(spark, docs, items, broadcast_rows=limit)
        assert {d for d, r in got.items() if r[0]} == {1, 2, 7, 9, None, 10}, got
        assert got[9][2] == 2 and got[2][1] == 1 and got[10][1] == 2 and got[4] == (False, None, 0)


def test_slots_must_be_consistent(spark):
    one = "a price of 5 and again 5 then 7 makes the whole sum that people pay here for bread"
    docs = [(1, one.replace("5", "8")), (2, one.replace("7", "5")), (3, one.replace("5", "6", 1))]
    assert {d for d, r in hits(spark, docs, [(1, one)]).items() if r[0]} == {1}


def test_names_that_begin_sentences(spark):
    item = "Maria picks 14 apples. Maria sells 5 apples. How many apples has Maria left?"
    docs = [(1, item.replace("Maria", "Paula").replace("14", "20")), (2, item), (3, item.replace("Maria", "Paula", 1)),
            (4, "So " + item.replace("Maria", "Paula")), (5, item.lower()), (6, item.replace("How", "What"))]
    assert {d for d, r in hits(spark, docs, [(1, item)]).items() if r[0]} == {1, 2, 4, 5, 6}


def test_short_items_and_items_of_values_are_found_as_they_are(spark):
    items = [(1, "What is 7 times 8?"), (2, "12 + 5 * 3 - 4 + 9 - 1 + 2 * 6 = ?"), (3, "Yes."), (4, "One two three four five six seven")]
    docs = [(1, "so\nwhat IS 7 times 8"), (2, "What is 7 times 9?"), (3, "12 5 3 4 9 1 2 6"), (4, "12 5 3 4 9 1 2 7"), (5, "yes"),
            (6, "yes or no"), (7, "zero one two three four five six seven eight"), (8, "one two three four five six eight"), (9, None),
            (7, "zero one two three four five six seven eight")]
    for limit in (10 ** 6, 0):
        assert {d for d, r in hits(spark, docs, items, broadcast_rows=limit).items() if r[0]} == {1, 3, 5, 7}


def test_texts_of_very_many_names_and_numbers(spark):
    tail = " and then " + ITEM
    docs = [(1, "so " + "Anna Bert " * 50_000 + tail), (2, "1.5," * 100_000 + "7" + tail), (3, "10 kg " * 100_000), (4, "Word. " * 100_000 + tail)]
    assert {d for d, r in hits(spark, docs, [(1, ITEM)]).items() if r[0]} == {1, 2, 4}


def test_contamination_of_nothing(spark):
    assert hits(spark, [], [(1, ITEM)]) == {}
    assert hits(spark, [(1, ITEM)], []) == {1: (False, None, 0)}


def test_clean_rows_keep_all_columns(spark):
    docs = spark.createDataFrame([(1, ITEM, "a"), (2, "clean", "b"), (None, None, "c")], "doc_id bigint, text string, row string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    left = decontaminate.without_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r.row for r in left.collect()) == ["b", "c"]


def scanned(docs):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    out = []
    for doc, text in docs:
        low = (text or "").translate(upper)
        words = word.findall(low)
        places = {p: [i for i in range(len(words)) if words[i:i + len(p.split())] == p.split()] for p in licenses.PHRASES}
        every = sorted(sum(places.values(), []))
        base = sorted(licenses.PHRASES[p] for p, found in places.items() if found)
        more, close, best = set(), set(), 0.0
        tokens = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+|\n", low)
        tokens = [t for i, t in enumerate(tokens) if t != "\n" or not i or tokens[i - 1] != "\n"]
        span = licenses.line_span(licenses.TEMPLATES)
        blocks = [set(word.findall(line)) for line in low.split("\n")]
        for i in (i for i, t in enumerate(tokens) if t == "\n"):
            after = [t for t in tokens[i + 1:i + 1 + 2 * span] if t != "\n"][:span]
            blocks.append({*tokens[max(0, i - span):i], *after} - {"\n"})
        for own in blocks:
            found = []
            for label, t in licenses.TEMPLATES:
                share = len(own & set(t.split())) / len(set(t.split()))
                if share >= licenses.THRESHOLD - 1e-9:
                    found.append((share, label, own & set(t.split())))
            best = max([best, *(share for share, _, _ in found)])
            more |= {label for _, label, _ in found}
            close |= {label for s, label, h in found if not any(s2 > s and h <= h2 for s2, _, h2 in found)}
        out.append((doc, len(words), len(every), every[0] if every else None, every[-1] if every else None, ",".join(base),
                    ",".join(sorted({*base, *more})), 1.0 if every else best, ",".join(sorted(close))))
    return sorted(out, key=repr)


def test_license_scan_equals_brute_force(spark):
    docs = [(1, "x\nReleased under the MIT License."), (2, "CC BY cc-by CC/BY"), (3, "All rights reserved"), (4, None), (5, ""), (6, "...\n\n"),
            (7, "the GNU General Public License v3. All RIGHTS reserved. all rights"), (8, "Licensed under CC BY-NC 4.0."), (9, "cc\nby"),
            (10, "license under the apache version 2"), (11, "Éall rights reserved"), (12, "all rights réserved"), (13, "cc by by cc by"),
            (3, "All rights reserved"), (None, "cc by"), (14, "w " * 60_000 + "all rights reserved"),
            (15, "Redistribution and use in source and binary forms, with or without modification, are permitted"),
            (16, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
            (17, "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated\n"
                 "# documentation files. Licensed under\n\n#\n# the Apache License 2.0, all rights reserved"),
            (18, "\n\nReleased\nunder the MIT\nlicense\n\n"), (19, "Licensed under the Apache License edition 2.0, or released under the MIT license"),
            (20, "\n".join("this work is licensed under the gnu general public license version 3".split()))]
    table = spark.createDataFrame([(d, t, "w", 1) for d, t in docs], "doc_id bigint, text string, words string, row int")
    got = sorted((tuple(r) for r in licenses.license_scan(table).collect()), key=repr)
    assert got == scanned(docs)
    assert licenses.license_scan(table.where("false")).collect() == []


def labels(spark, *texts, column="labels"):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r[column] for r in licenses.license_scan(table).orderBy("doc_id").collect()]


def test_notices_beside_closer_ones_in_a_line_are_found(spark):
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "conditions are met")
    apache = "Licensed under the Apache License edition 2.0"
    texts = [f"All rights reserved. {bsd}", f"{apache}, or released under the MIT license", "Licensed under CC BY-NC 4.0",
             "Licensed under CC BY-NC 4.0 or CC BY-SA 4.0"]
    assert labels(spark, *texts) == ["bsd,reserved", "apache,mit", "cc-by,cc-by-nc,cc-by-sa", "cc-by,cc-by-nc,cc-by-sa"]
    assert labels(spark, *texts, column="closest") == ["bsd,reserved", "apache,mit", "cc-by-nc", "cc-by-nc,cc-by-sa"]


def test_code_and_sql_agree_on_wrapped_and_double_notices(spark):
    import duckdb
    from ledgermill.llm import queries

    bsd = "Redistribution and use in source and binary forms, with or\n * without modification, are\n\n * permitted provided that the conditions are met"
    texts = [bsd, f"All rights reserved.\n{bsd}", "Licensed under CC BY-NC 4.0\nor CC BY-SA 4.0", "Permission is hereby granted, free of charge, to any\n"
             "person obtaining a copy\nof this software and associated documentation files", None, "", "\n", "released under\n\n...\nthe MIT license",
             "the GNU general public license\nversion 3: this work is licensed under", "all rights\nreserved"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted(tuple(r) for r in licenses.license_scan(table).collect())
    connection = duckdb.connect()
    connection.execute("create table documents (doc_id bigint, text varchar)")
    connection.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    assert got == sorted(connection.execute(queries.oracle_sql()["op9_licenses"]).fetchall())


def test_wrapped_notices_are_found(spark):
    mit = ("# Permission is hereby granted, free of charge, to any person obtaining a copy\n"
           "# of this software and associated documentation files (the \"Software\"), to deal\n")
    bsd = (" * Redistribution and use in source and binary forms, with or\n *\n * without modification, are permitted\n"
           " * provided that the following conditions are met:\n")
    isc = "// Permission to use, copy, modify, and/or distribute this software for any\r\n// purpose with or without fee is hereby granted"
    tall = "\n".join("redistribution and use in source and binary forms with or without modification are permitted provided that the "
                     "following conditions are met".split())
    apart = "Released\n" + "word " * 40 + "\nunder the MIT license"
    assert labels(spark, mit, f"int main;\n{bsd}{mit}", isc, tall, "\nall rights\n\nreserved\n", apart) == [
        "mit", "bsd,mit", "isc", "bsd", "reserved", "mit"]
    assert labels(spark, "Licensed\n" + "word " * 80 + "\nunder the Apache\n" + "word " * 80 + "\nlicense version 2") == [""]

"""License notices in texts: fixed phrases, and templates found by an exact set-similarity join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialise

# Phrases whose every place counts, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices by label. A block of text bears a label if it has this share of a notice's distinct words.
THRESHOLD = 0.8
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("reserved", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Whatever is neither a digit, an ASCII letter, nor outside ASCII parts words.
_PARTS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_APART = "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def line_span(templates: list[tuple[str, str]]) -> int:
    """Words that the longest notice can take up, with others between its own."""
    return max(len(text.split()) for _, text in templates) * 3 // 2


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                 templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """License phrases and notices of every row.

    Returns `doc_id`, `n_words`, `n_base` (places of the fixed phrases), `first_word` and `last_word` (smallest and
    largest start of such a place, in words from 0), `base_labels`, `labels` (also those of notices; distinct, sorted,
    joined by commas), `score` (1 with a fixed phrase, else the largest share of a notice's words that one block
    has, if it reaches `threshold`, else 0) and `closest` (the labels of notices without those whose words in the block
    are all among those of a closer notice: a CC BY-NC notice has 6 of the 7 words of the CC BY-SA one and no word that
    speaks for it).

    Blocks are lines, and around each line end the words before and after it, as many on each side as the longest notice
    can take up, so notices wrapped over lines are found whole; a label counts once however many blocks bear it. Of each block only the
    words that occur in some notice are kept, so blocks are short sets and no text is shuffled. Words are ordered by the number of blocks that have them, over all rows, rarest first. A notice
    of n words of which c must be found has its first n - c + 1 words as prefix, and so has a block: two such sets can
    only be alike enough if their prefixes share a word, they have c words each, and the words after the shared one
    suffice. What passes these filters is compared in full, so every block that reaches the threshold is found,
    and gets the labels of all notices that it does so for.

    Null and empty texts have no words, no labels and score 0. Each row is scanned on its own: ids may be null or
    repeated. Other columns are ignored.
    """
    low = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), _UPPER, _LOWER)
    sets = [(label, sorted(set(text.split()))) for label, text in templates]
    vocabulary = sorted({word for _, words in sets for word in words})
    need = [max(1, _least(len(words), threshold)) for _, words in sets]

    span = line_span(templates)
    # Words and line ends in their order; line ends without words between are one. Of the words only those that occur in some notice are kept.
    marked = F.split(F.trim(F.regexp_replace(F.regexp_replace("low", _APART, " "), " ?\n[ \n]*", " \n ")), " ")
    slim = F.transform("marked", lambda word: F.when(word.isin(vocabulary) | (word == "\n"), word))
    ends = F.filter(F.transform("marked", lambda word, at: F.when(word == "\n", at)), lambda at: at.isNotNull())
    known = lambda part: F.filter(F.array_distinct(part), lambda word: word.isNotNull() & (word != "\n"))
    edges = F.concat(F.array(F.lit(-1)), "ends", F.array(F.size("slim")))
    lines = F.transform(F.sequence(F.lit(0), F.size("ends")), lambda i: known(
        F.slice("slim", F.get("edges", i) + 2, F.get("edges", i + 1) - F.get("edges", i) - 1)))
    words = lambda part: F.filter(part, lambda word: word.isNull() | (word != "\n"))
    runs = F.transform("ends", lambda at: known(F.concat(
        F.slice("slim", F.greatest(at + 1 - span, F.lit(1)), F.least(at, F.lit(span))),
        F.slice(words(F.slice("slim", at + 2, F.lit(2 * span))), 1, span))))
    read = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), low.alias("low")).select(
        "doc_id", F.xxhash64("doc_id", "low").alias("row"), marked.alias("marked"))
    read = read.select("doc_id", "row", slim.alias("slim"), ends.alias("ends"), F.array_join(F.filter(
        "marked", lambda word: word != "\n"), " ").alias("tidy")).withColumn("edges", edges)
    read = read.withColumn("blocks", F.concat(F.filter(lines, lambda words: F.size(words) > 0),
                                              F.filter(runs, lambda words: F.size(words) >= min(need))))
    padded = F.concat(F.lit(" "), F.col("tidy"), F.lit(" "))
    found = {phrase: F.contains(F.col("padded"), F.lit(f" {phrase} ")) for phrase in PHRASES}
    pieces = {phrase: F.when(found[phrase], F.split("padded", f" {phrase}(?= )")) for phrase in PHRASES}
    starts = [_spaces(F.element_at(pieces[p], 1)) for p in PHRASES]
    ends = [F.col("n_words") + 1 - _spaces(F.element_at(pieces[p], -1)) - len(p.split()) for p in PHRASES]
    read = read.withColumns({
        "padded": padded, "n_words": F.when(F.col("tidy") == "", 0).otherwise(_spaces(F.col("tidy")) + 1).cast("bigint"),
    }).select(
        "doc_id", "row", "n_words", "blocks",
        reduce(Column.__add__, [F.coalesce(F.size(pieces[p]) - 1, F.lit(0)) for p in PHRASES]).cast("bigint").alias("n_base"),
        F.least(*starts).cast("bigint").alias("first_word"), F.greatest(*ends).cast("bigint").alias("last_word"),
        F.array_compact(F.array(*[F.when(found[p], F.lit(label)) for p, label in PHRASES.items()])).alias("base"))
    read = materialise(read)

    spread = read.select("row", F.explode("blocks").alias("words"))
    counts = spread.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("blocks"))
    # At most one row for each word of the notices.
    counted = dict(counts.collect())
    rank = {word: i for i, word in enumerate(sorted(vocabulary, key=lambda w: (counted.get(w, 0), w)))}
    ordered = [(label, sorted(words, key=rank.get)) for label, words in sets]
    prefixes = read.sparkSession.createDataFrame(
        [(n, word, at, len(words), need[n], words, label) for n, (label, words) in enumerate(ordered)
         for at, word in enumerate(words[:len(words) - need[n] + 1])],
        "notice int, word string, at int, size int, need int, notice_words array<string>, label string")
    by_rank = _strings(sorted(vocabulary, key=rank.get))
    ranked = spread.where(F.size("words") >= min(need)).distinct().select(
        "row", F.array_intersect(by_rank, F.col("words")).alias("words"))
    heads = ranked.select("row", "words", F.posexplode(F.slice("words", 1, F.size("words") - min(need) + 1)).alias("at_block", "word"))
    room = F.least(F.col("size") - F.col("at"), F.size("words") - F.col("at_block"))
    met = heads.join(F.broadcast(prefixes), "word").where(
        (F.size("words") >= F.col("need")) & (F.col("at_block") <= F.size("words") - F.col("need")) & (room >= F.col("need") - F.least("at", "at_block")))
    hits = F.array_intersect("words", "notice_words")
    alike = met.select("row", "words", "label", "size", "need", hits.alias("hits")).where("size(hits) >= need")
    # At most one entry for each notice.
    own = F.struct((F.size("hits") / F.col("size")).alias("share"), "label", "hits")
    found = alike.groupBy("row", "words").agg(F.collect_set(own).alias("all"))
    contained = lambda one: F.exists("all", lambda other: (other["share"] > one["share"]) & (
        F.size(F.array_except(one["hits"], other["hits"])) == 0))
    each = found.select("row", F.explode(F.transform("all", lambda one: F.struct(
        one["label"].alias("label"), one["share"].alias("share"), (~contained(one)).alias("close")))).alias("one")).select("row", "one.*")
    labels = each.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"),
                                     F.collect_set(F.when(F.col("close"), F.col("label"))).alias("close"))
    none = F.array().cast("array<string>")
    whole = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", none))))
    return read.drop("blocks").join(labels, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(whole, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        F.array_join(F.array_sort(F.coalesce("close", none)), ",").alias("closest"))


def _least(size: int, threshold: float) -> int:
    """Fewest words that make up the share; whole shares are not lost to rounding."""
    return -int(-(size * threshold - 1e-9) // 1)

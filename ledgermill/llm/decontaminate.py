"""Documents that hold benchmark items, also with other numbers, names and units, by windows of templates."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialise

# Words of a window, words of it that must not be placeholders, and windows in line that make a hit.
WINDOW, LITERAL_WORDS, HIT_WINDOWS = 8, 4, 4
# Items without windows are found anywhere if they have this many words, shorter ones as a text of their own.
ANYWHERE_WORDS = 4

# Rows of the benchmark's window table that are broadcast at most; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000

# Private characters around a marked value, and before a capitalised word that begins a sentence or line.
OPEN, CLOSE, START = "\ue000", "\ue001", "\ue002"
_UNITS = ("km|cm|mm|kg|mg|ml|km/h|mph|m|g|l|hours?|minutes?|seconds?|days?|weeks?|months?|years?|miles?|feet|inches|"
          "meters?|metres?|grams?|kilograms?|liters?|litres?|dollars?|euros?|pounds?|cents?|usd|eur|percent")


def marks(any_number: str) -> list[tuple[str, str]]:
    """Patterns and what they become, in this order. `any_number` repeats a group: an engine that calls itself for each
    repetition needs the possessive form, which finds the same here, since nothing that follows could take any back."""
    return [
        (f"[{OPEN}{CLOSE}{START}]", " "),
        (f"(\\p{{Nd}}+(?:[.,]\\p{{Nd}}+){any_number})", f"{OPEN}n$1{CLOSE}"),
        (f"{CLOSE}[ \\t]*({_UNITS}|%|€|\\$)([^\\p{{L}}\\p{{N}}]|$)", f"{CLOSE}{OPEN}u$1{CLOSE}$2"),
        (f"([^ \\t\\n\\r.!?:][ \\t]+)(\\p{{Lu}}\\p{{Ll}}+(?:[ \\t]+\\p{{Lu}}\\p{{Ll}}+){any_number})", f"$1{OPEN}p$2{CLOSE}"),
        ("(^[ \\t]*|[\\n\\r.!?:][ \\t]*)(\\p{Lu}\\p{Ll})", f"$1{START}$2"),
    ]


TYPES = (f"{OPEN}(.)[^{CLOSE}]*{CLOSE}", f" {OPEN}$1 ")
VALUES = f"{OPEN}[a-z][^{CLOSE}]*{CLOSE}|{START}?[\\p{{L}}\\p{{N}}]+"
NOT_WORDS = f"[^\\p{{L}}\\p{{N}}{OPEN}{START}]+"
#: What a value has besides its text.
BARE = f"^{OPEN}[a-z]|{CLOSE}$|^{START}"
NOT_PLAIN = "[^\\p{L}\\p{N}]+"


def marked(text: Column) -> Column:
    """Text with numbers, units after numbers, and names between marks, and with a mark before capitalised words that
    begin a sentence or line. A name is a run of capitalised words that does not."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    for pattern, into in marks("*+"):
        text = F.regexp_replace(text, pattern, into)
    return text


def template(text: Column) -> Column:
    """Lower-case words of a marked text, with one placeholder by type for each marked value; words that begin sentences
    keep their mark."""
    plain = F.lower(F.regexp_replace(text, *TYPES))
    return F.filter(F.split(plain, NOT_WORDS), lambda word: word != "")


def values(text: Column) -> Column:
    """As `template`, with the values in place of the placeholders."""
    return F.regexp_extract_all(text, F.lit(f"({VALUES})"))


def plain_words(text: Column) -> Column:
    """Lower-case words of a text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_PLAIN), lambda word: word != "")


def _begins(word: Column) -> Column:
    return F.startswith(word, F.lit(START))


def _as_word(word: Column) -> Column:
    return F.when(_begins(word), F.substr(word, F.lit(2))).otherwise(word)


def _as_name(word: Column) -> Column:
    return F.when(_begins(word), F.lit(f"{OPEN}p")).otherwise(word)


def _windowed(rows: DataFrame, text_col: str, window: int, read: Callable[[Column], Column], *keep: str) -> DataFrame:
    """One row per window: `window_hash` and its place `at`. `read` says how words that begin sentences are taken."""
    words = rows.select(*keep, template(marked(F.col(text_col))).alias("words"))
    hashes = words.select(*keep, F.transform("words", lambda word: F.xxhash64(read(word))).alias("hashes"))
    places = F.when(F.size("hashes") >= window, F.sequence(F.lit(0), F.size("hashes") - window))
    each = F.transform(places, lambda at: F.xxhash64(*[F.get("hashes", at + k) for k in range(window)]))
    # The outer form, since the planner pushes a test of the inner one's array, with all it is made of, into the scan.
    return hashes.select(*keep, each.alias("each")).select(*keep, F.posexplode_outer("each").alias("at", "window_hash"))


def _item_windows(items: DataFrame, window: int, literal_words: int, read: Callable[[Column], Column]) -> DataFrame:
    """Windows of the items with enough literal words."""
    known = _windowed(items, "item_text", window, read, "item", "item_id", "item_text").withColumnRenamed("at", "item_at")
    part = F.slice(template(marked(F.col("item_text"))), F.col("item_at") + 1, F.lit(window))
    literal = F.size(F.filter(part, lambda word: ~F.startswith(read(word), F.lit(OPEN))))
    return known.where(literal >= literal_words)


def _plain_hits(keyed: DataFrame, items: DataFrame, window: int, broadcast_rows: int) -> DataFrame:
    """Places of items whose words all stand in line in a document: `doc_id`, `row`, `item_id`, `offset`, `n_windows`.

    Items and documents meet by the hash of the item's first `window` words, or all of a shorter one's.
    """
    known = items.select("item_id", plain_words(F.col("item_text")).alias("item_words")).where(F.size("item_words") > 0).distinct()
    size = F.least(F.size("item_words"), F.lit(window))
    known = materialise(known.withColumn("size", size).withColumn(
        "key", F.xxhash64("size", F.slice("item_words", F.lit(1), F.col("size")))))
    sizes = [row["size"] for row in known.select("size").distinct().collect()]  # at most one for each size of a window
    none = keyed.select("doc_id", "row", F.lit(0).cast("bigint").alias("item_id"), F.lit(0).alias("offset"),
                        F.lit(0).cast("bigint").alias("n_windows")).where("false")
    if not sizes:
        return none
    lookup = known.select("key", "item_id", "item_words")
    lookup = F.broadcast(lookup) if known.count() <= broadcast_rows else lookup
    words = keyed.select("doc_id", "row", plain_words(F.col("doc_text")).alias("words"))
    windows = lambda k: F.when(F.size("words") >= k, F.transform(
        F.sequence(F.lit(0), F.size("words") - k), lambda at: F.struct(
            at.alias("offset"), F.xxhash64(F.lit(k), F.slice("words", at + 1, k)).alias("key"))))
    each = F.flatten(F.array_compact(F.array(*[windows(k) for k in sizes])))
    found = words.select("doc_id", "row", F.explode_outer(each).alias("one")).select("doc_id", "row", "one.*")
    met = materialise(found.join(lookup, "key").select("row", "item_id", "item_words", "offset").distinct())
    texts = keyed.join(met.select("row").distinct(), "row", "left_semi").select(
        "doc_id", "row", plain_words(F.col("doc_text")).alias("words")).dropDuplicates(["row"])
    length = F.size("item_words")
    whole = F.slice("words", F.col("offset") + 1, length) == F.col("item_words")
    enough = (length >= ANYWHERE_WORDS) | (F.size("words") == length)
    return met.join(texts, "row").where(whole & enough).select(
        "doc_id", "row", "item_id", "offset", F.greatest(length - window + 1, F.lit(1)).cast("bigint").alias("n_windows"))


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                   literal_words: int = LITERAL_WORDS, hit_windows: int = HIT_WINDOWS,
                   broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Places where a document runs along a benchmark item: `doc_id`, `row`, `item_id`, `offset`, `n_windows`, `n_slots`.

    Both sides are brought to templates: numbers, units and names become placeholders by type. Capitalised words that
    begin sentences are names too, in items also words, since a document may have them in other places. Windows of
    `window` template words, of which `literal_words` at least are literal, are joined by hash. Windows of one document and
    item at one `offset` (place in the document less place in the item) belong together. They are a hit if there are
    `hit_windows` of them (or all of a short item's) and the slots are consistent: equal values of the item stand for
    equal values in the document and different ones for different ones, whatever their case, as in a question with new
    parameters; words that begin the item's sentences are slots too.
    `n_slots` counts different slot values. `row` tells apart documents that share an id.

    Items without a window that counts (names read as such), being short or holding few literal words, are found where all their words
    stand in line, values included; those of fewer than four words only where a document has no other words.

    The benchmark's windows are counted, and broadcast only up to `broadcast_rows`; a larger benchmark is joined by a
    shuffle. Documents are never collected: the windows of a hit are gathered per item and offset, which the item's
    length bounds.

    Null and empty texts have no windows; items without words are not looked for; repeated items and
    items without an id are looked for under each of their ids. Texts may have any length. Other columns are ignored.
    """
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).cast("string").alias("item_text"))
    items = items.distinct().withColumn("item", F.xxhash64("item_id", "item_text"))
    known = materialise(reduce(DataFrame.union, [
        _item_windows(items, window, literal_words, read).withColumn("named", F.lit(read is _as_name)) for read in (_as_name, _as_word)]))
    rows = known.count()
    usable = known.where("named").groupBy("item").agg(F.count(F.lit(1)).alias("item_windows"), F.first("item_text").alias("item_text"))
    lookup = known.select("window_hash", "item", "item_id", "item_at").distinct()
    lookup = F.broadcast(lookup) if rows <= broadcast_rows else lookup

    keyed = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("doc_text"))
    keyed = keyed.withColumn("row", F.xxhash64("doc_id", "doc_text"))
    plain = _plain_hits(keyed, items.join(usable.select("item"), "item", "left_anti"), window, broadcast_rows)
    met = _windowed(keyed, "doc_text", window, _as_name, "doc_id", "row").join(lookup, "window_hash").select(
        "doc_id", "row", "item", "item_id", "item_at", (F.col("at") - F.col("item_at")).alias("offset"))
    runs = met.groupBy("doc_id", "row", "item", "item_id", "offset").agg(F.sort_array(F.collect_set("item_at")).alias("places"))
    runs = materialise(runs.join(usable, "item").where(
        F.size("places") >= F.least(F.lit(hit_windows), F.col("item_windows"))).drop("item_windows"))
    found = keyed.join(runs.select("row").distinct(), "row", "left_semi").select(
        "row", values(marked(F.col("doc_text"))).alias("found")).dropDuplicates(["row"])
    runs = runs.join(found, "row")
    runs = runs.withColumn("own", values(marked(F.col("item_text"))))
    places = F.array_distinct(F.flatten(F.transform("places", lambda at: F.sequence(at, at + window - 1))))
    bare = lambda value: F.lower(F.regexp_replace(value, BARE, ""))
    slotted = F.filter(places, lambda at: F.get("own", at).rlike(f"^[{OPEN}{START}]"))
    slots = F.array_distinct(F.transform(slotted, lambda at: F.struct(
        bare(F.get("own", at)).alias("item"), bare(F.get("found", at + F.col("offset"))).alias("doc"))))
    runs = runs.withColumn("slots", slots)
    one_to_one = (F.size(F.array_distinct(F.transform("slots", lambda p: p["item"]))) == F.size("slots")) & (
        F.size(F.array_distinct(F.transform("slots", lambda p: p["doc"]))) == F.size("slots"))
    return runs.where(one_to_one).select(
        "doc_id", "row", "item_id", "offset", F.size("places").cast("bigint").alias("n_windows"),
        F.size("slots").cast("bigint").alias("n_slots")).unionByName(plain.withColumn("n_slots", F.lit(0).cast("bigint")))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """For every row of `docs`: `doc_id`, `contaminated`, `n_items` found in it, the `item_id` with the most windows in
    line (the smallest of equals) and `n_windows` of it; null and 0 without a hit. Options are those of `benchmark_hits`."""
    hits = benchmark_hits(docs, benchmark, id_col, text_col, **options)
    best = hits.groupBy("row").agg(
        F.countDistinct("item_id").alias("n_items"),
        F.min(F.struct((-F.col("n_windows")).alias("fewer"), "item_id")).alias("best"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("doc_text")).select(
        "doc_id", F.xxhash64("doc_id", "doc_text").alias("row"))
    return rows.join(best, "row", "left").select(
        "doc_id", F.col("best").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.col("best.item_id").alias("item_id"), F.coalesce(-F.col("best.fewer"), F.lit(0)).cast("bigint").alias("n_windows"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs`, all columns, that hold no benchmark item."""
    rows = benchmark_hits(docs, benchmark, id_col, text_col, **options).select(F.col("row").alias("__llm_row")).distinct()
    own = F.xxhash64(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return docs.join(rows, own == F.col("__llm_row"), "left_anti")

"""Spelling variants: words one edit apart, found by one-edit neighbourhoods over a reduced alphabet."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialise
from .arrays import mix, seeds

# Letters of a word and its occurrences, at least; how many times more frequent its form must be.
LEAST_LETTERS, LEAST_COUNT, FORM_FACTOR = 7, 2, 10
# One of so many runs of a document loses a letter.
DAMAGED = 31
# Symbols that letters are reduced to.
SYMBOLS = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bits of the map of keys that occur, a power of two: what is sent to the executors has 8 MB for any vocabulary.
MAP_BITS = 1 << 26

# Keys made at once.
_KEYS_AT_ONCE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUES = seeds(SYMBOLS, 41)
# The symbol of each letter, by a hash of the letter, and its bit in the set of a word's letters. All letters are Latin-1.
_SYMBOL = (mix(np.arange(256, dtype=np.uint64)) % np.uint64(SYMBOLS)).astype(np.uint8)
_BIT = np.int32(1) << (np.arange(256, dtype=np.int32) % np.int32(31))


def runs_of_letters(text: Column) -> Column:
    """Maximal runs of Latin letters, A-Z in lower case."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit("([A-Za-zÀ-ÿ]+)"))


def damaged(run: Column, doc_id: Column) -> Column:
    """The run, without one letter if the hash of the document's id and the run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    less = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % DAMAGED == 0, less).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS,
               least_count: int = LEAST_COUNT) -> DataFrame:
    """`word`, `n`: words of enough letters with the number of their occurrences in all texts."""
    doc_id = F.col(id_col).cast("bigint")
    runs = F.filter(runs_of_letters(F.col(text_col).cast("string")), lambda run: F.length(run) >= least_letters)
    each = docs.select(doc_id.alias("doc_id"), F.explode(runs).alias("run")).select(
        damaged(F.col("run"), F.col("doc_id")).alias("word"))
    return each.where(F.length("word") >= least_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= least_count)


def neighbourhood(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of all words at most one edit from each row of a matrix of symbols, each once: row numbers and hashes.

    A word's hash adds up its symbols times powers of a base, so that of an edited word is made of the sums before and
    after the edit. Edits that give the same word are left out by rule: of a run of equal symbols only the first is
    deleted, a symbol is never replaced by itself, and is inserted only at the end or before another one.
    """
    rows, width = symbols.shape
    power, inverse = np.full(width + 1, _BASE), np.full(width + 1, _INVERSE)
    power[0] = inverse[0] = 1
    power, inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
    parts = _VALUES[symbols] * power[:width]
    before = np.zeros((rows, width + 1), np.uint64)
    np.cumsum(parts, axis=1, out=before[:, 1:])
    total = before[:, -1:]
    size = lambda hashes, n: mix(hashes + np.uint64(n))
    yield np.arange(rows), size(total[:, 0], width)
    step = max(1, _KEYS_AT_ONCE // (max(1, rows) * SYMBOLS))
    for begin in range(0, width + 1, step):
        at = np.arange(begin, min(begin + step, width + 1))
        inner = at[at < width]
        own = symbols[:, inner]
        # Deletions.
        first = np.ones(own.shape, bool)
        later = inner > 0
        first[:, later] = own[:, later] != symbols[:, inner[later] - 1]
        row, i = np.nonzero(first)
        gone = before[:, inner] + (total - before[:, inner + 1]) * _INVERSE
        yield row, size(gone[row, i], width - 1)
        values = _VALUES
        # Replacements.
        row, i, s = np.nonzero(own[:, :, None] != np.arange(SYMBOLS))
        changed = (total - parts[:, inner])[row, i] + values[s] * power[inner[i]]
        yield row, size(changed, width)
        # Insertions before each place and at the end.
        other = np.ones((rows, len(at), SYMBOLS), bool)
        other[:, :len(inner)] = own[:, :, None] != np.arange(SYMBOLS)
        row, i, s = np.nonzero(other)
        moved = (before[:, at] + (total - before[:, at]) * _BASE)[row, i] + values[s] * power[at[i]]
        yield row, size(moved, width + 1)


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length: row numbers and their letters, with few enough edits at once."""
    words = [word.encode("latin-1") for word in batch.column(1).to_pylist()]
    lengths = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    begins = np.cumsum(lengths) - lengths
    for width in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == width)
        step = max(1, _KEYS_AT_ONCE // ((width + 1) * (2 * SYMBOLS + 1)))
        for i in range(0, len(rows), step):
            part = rows[i:i + step]
            yield part, data[begins[part][:, None] + np.arange(width)]


def _letter_sets(letters: np.ndarray) -> np.ndarray:
    """Which letters each row holds, as bits."""
    return np.bitwise_or.reduce(_BIT[letters], axis=1)


def _own_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word's own key and letters."""
    for batch in batches:
        keys, sets = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.int32)
        for rows, letters in _matrices(batch):
            keys[rows] = next(neighbourhood(_SYMBOL[letters]))[1]
            sets[rows] = _letter_sets(letters)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys.view(np.int64)), pa.array(sets)], names=["id", "key", "letters"])


def _all_keys(batches: Iterator[pa.RecordBatch], occurring: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The keys of each word's neighbourhood, without those that the map says no word has."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for rows, letters in _matrices(batch):
            sets = _letter_sets(letters)
            for row, keys in neighbourhood(_SYMBOL[letters]):
                bit = keys & np.uint64(MAP_BITS - 1)
                known = (occurring[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
                row, keys = row[known], keys[known]
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows[row]]), pa.array(keys.view(np.int64)), pa.array(sets[row])],
                                                 names=["id", "key", "letters"])


def _occurring(keys: DataFrame) -> np.ndarray:
    """Map of `MAP_BITS` bits, in which the last bits of each key are set."""
    place = F.col("key").bitwiseAND(MAP_BITS - 1) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(MAP_BITS // 8, np.uint8)
    for row in parts.collect():  # at most one for each 4 KB of the map
        own = np.frombuffer(row["bits"], np.uint8)
        out[(row["bucket"] - 1) * len(own):][:len(own)] = own
    return out


def one_edit_apart(one: str, other: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes one word the other."""
    if one == other or abs(len(one) - len(other)) > 1:
        return False
    low, high = 0, min(len(one), len(other))
    while low < high:  # length of the common beginning
        middle = (low + high + 1) // 2
        low, high = (middle, high) if one[low:middle] == other[low:middle] else (low, middle - 1)
    if len(one) == len(other):
        return one[low + 1:] == other[low + 1:]
    return one[low + 1:] == other[low:] if len(one) > len(other) else one[low:] == other[low + 1:]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        near = pa.array([one_edit_apart(one, other) for one, other in pairs], pa.bool_())
        yield batch.select([0, 2, 3]).filter(near)


def near_words(words: DataFrame) -> DataFrame:
    """Pairs of one-edit neighbours among words with an `id`, both ways round: `id`, `near`, `near_n`.

    Words whose reduced forms are at most one edit apart share a key. An edit changes the set of a word's letters by two
    at most, which most of the other pairs do not pass; the words themselves decide.
    """
    small, keys = words.select("id", "word"), "id bigint, key bigint, letters int"
    own = materialise(small.mapInArrow(_own_keys, keys))
    occurring = words.sparkSession.sparkContext.broadcast(_occurring(own))
    # A key goes without its word, which may be long.
    around = small.mapInArrow(lambda batches: _all_keys(batches, occurring.value), keys)
    others = own.select("key", F.col("id").alias("other"), F.col("letters").alias("other_letters"))
    met = around.join(others, "key").where("id != other AND bit_count(letters ^ other_letters) <= 2").select("id", "other")
    both = met.join(words.select("id", F.col("word").alias("word")), "id").join(
        words.select(F.col("id").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n")), "other")
    return both.select("id", "word", "near", "near_n").mapInArrow(_verified, "id bigint, near string, near_n bigint")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT,
                      factor: int = FORM_FACTOR) -> DataFrame:
    """Words of all texts with their usual spelling: `word`, `form`, `root`, `n`, `n_near`, `form_n`.

    Words are runs of Latin letters, some of which lose a letter by a hash of the document's id, of `least_letters` letters and
    `least_count` occurrences (`n`) at least. Two words are near if one inserted, deleted or replaced letter makes one
    the other; `n_near` counts a word's near words. Its `form` is the near word with most occurrences (the smallest of
    equals) if they are `factor` times its own at least, else null; `root` is where forms lead to in the end.

    Letters are reduced to 8 symbols by a hash. The full one-edit neighbourhood of every reduced word is generated, as
    hashes, and joined with the hashes of the reduced words: near words always meet, and the few others that do are told
    apart by their letters. Of a neighbourhood only hashes whose last bits some word's hash has go into the shuffle (a
    map of fixed size says which; it loses none). They are rows of two numbers, so long words cost no more than their
    length, and words are fetched for pairs that met only. Forms are at least `factor` times as frequent, so the chains to the roots
    have few steps, which are taken by doubling.

    Null and empty texts have no words. Rows that repeat an id, or repeat everything, count each; a null id counts as
    empty text in the hash. Runs of any length are words. Other columns are ignored, and no words give no rows.
    """
    words = materialise(vocabulary(docs, id_col, text_col, least_letters, least_count).withColumn(
        "id", F.monotonically_increasing_id()))
    best = F.min(F.struct((-F.col("near_n")).alias("fewer"), "near"))
    around = near_words(words).groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    usual = -F.col("best.fewer") >= factor * F.col("n")
    found = materialise(words.join(around, "id", "left").select(
        "word", F.when(usual, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(usual, -F.col("best.fewer")).alias("form_n")))
    return found.join(_roots(found.where("form IS NOT NULL").select("word", "form")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """`word`, `root`: where the forms of each word lead to. Each round doubles the steps taken."""
    at = materialise(forms.withColumnRenamed("form", "root"))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialise(at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                               F.col("further").isNotNull().alias("moved")))
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")

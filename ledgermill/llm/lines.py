"""Removal of repeated runs of lines, found by winnowing over line hashes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ..sources.shared import materialise

# Words a run must have to be removed where it is repeated.
RUN_WORDS = 50

# A mark or run with more than this share of all rows is joined by a broadcast, so there are never more of them than its
# inverse.
HOT_SHARE = 1e-4

_LINES = "doc_id bigint, version bigint, numbers array<int>, hashes array<bigint>, sizes array<int>, marks array<int>"
_RUNS = "doc_id bigint, version bigint, start int, stop int, mark bigint, left bigint, right bigint"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def read_lines(text: str) -> tuple[list[int], list[int], list[int]]:
    """Numbers, hashes and word counts of the lines that are not blank. Blanks around a line are not part of it."""
    lines = [(i, own) for i, own in enumerate(x.strip() for x in text.encode().split(b"\n")) if own]
    return ([i for i, _ in lines], [_signed(xxh3_64_intdigest(own)) for _, own in lines],
            [len(own.split()) for _, own in lines])


def windows(hashes: list[int], sizes: list[int], run_words: int) -> list[tuple[int, int]]:
    """For each line from which on there are `run_words` words: the last line of the shortest window that has them, and
    the window's fingerprint, the line of smallest hash (the last of equal ones)."""
    found, end, total = [], 0, 0
    for begin in range(len(hashes)):
        while end < len(hashes) and total < run_words:
            total += sizes[end]
            end += 1
        if total < run_words:
            break
        found.append((end - 1, -min((hashes[k], -k) for k in range(begin, end))[1]))
        total -= sizes[begin]
    return found


def extended(sizes: list[int], seeds: list[tuple[int, int]], run_words: int) -> Iterator[tuple[int, int, int]]:
    """Runs around fingerprints: first line, last line, fingerprint.

    A fingerprint is extended to the left up to the line whose window it marks, and to the right up to the end of that
    window and further: to each line that still needs the first one to reach `run_words` words, and from one line that
    has enough of them alone to the next. Every line of every run of `run_words` words or more lies in one of these
    inside of the run: from a line on, either the run's rest is long enough for a window that begins there, or the
    shortest run that ends there begins inside of it.
    """
    for begin, (end, mark) in enumerate(seeds):
        yield begin, end, mark
    begin, total = 0, 0
    for end, size in enumerate(sizes):
        total += size
        while total - sizes[begin] >= run_words:
            total -= sizes[begin]
            begin += 1
        if total >= run_words and seeds[begin][0] < end:
            yield begin, end, seeds[begin][1]
        if end and min(size, sizes[end - 1]) >= run_words:
            yield end - 1, end, end - 1


def _fingerprinted(batches: Iterator[pa.RecordBatch], run_words: int) -> Iterator[pa.RecordBatch]:
    """Lines of each text, and which of them are fingerprints."""
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
    for batch in batches:
        rows, held = [], 0
        for doc, version, text in zip(*(column.to_pylist() for column in batch.columns)):
            numbers, hashes, sizes = read_lines(text or "")
            marks = sorted({mark for _, mark in windows(hashes, sizes, run_words)})
            if marks:
                rows.append((doc, version, numbers, hashes, sizes, marks))
                held += len(numbers)
            if held > 100_000:
                yield _batch(rows, kinds, _LINES)
                rows, held = [], 0
        if rows:
            yield _batch(rows, kinds, _LINES)


def _extended(batches: Iterator[pa.RecordBatch], run_words: int) -> Iterator[pa.RecordBatch]:
    """Runs around the fingerprints that occur more than once, with the hashes of what is left and right of them."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        rows = []
        for doc, version, numbers, hashes, sizes, shared in zip(*(column.to_pylist() for column in batch.columns)):
            known, side = set(shared), [h.to_bytes(8, "little", signed=True) for h in hashes]
            for begin, end, mark in extended(sizes, windows(hashes, sizes, run_words), run_words):
                if mark in known:
                    rows.append((doc, version, numbers[begin], numbers[end], hashes[mark],
                                 _signed(xxh3_64_intdigest(b"".join(side[begin:mark]))),
                                 _signed(xxh3_64_intdigest(b"".join(side[mark + 1:end + 1])))))
            if len(rows) > 50_000:
                yield _batch(rows, kinds, _RUNS)
                rows = []
        if rows:
            yield _batch(rows, kinds, _RUNS)


def _batch(rows: list[tuple], kinds: list[pa.DataType], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=[part.split()[0] for part in schema.split(", ")])


def _repeated(rows: DataFrame, on: list[str], place: Column, *keep: Column) -> DataFrame:
    """The rows whose key is at more than one place, with the key's first place as `first`.

    Keys are reduced to their first and last place and their number before any shuffle. Keys with more than
    `HOT_SHARE` of all rows, which are few by their definition, go to all tasks; only the others are joined by shuffle.
    """
    keys = materialise(rows.groupBy(*on).agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("rows")).where(
        "first != last").drop("last"))
    total = rows.count()
    hot = keys.where(F.col("rows") > HOT_SHARE * total).drop("rows")
    cold = keys.where(F.col("rows") <= HOT_SHARE * total).drop("rows")
    held = rows.join(F.broadcast(hot), on)
    others = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on)
    return held.unionByName(others).select(*keep, "first")


def without_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          run_words: int = RUN_WORDS) -> DataFrame:
    """`docs` with later copies of runs of lines taken out of the text, and two more columns.

    A line goes if it lies in a run of whole lines with at least `run_words` words that occurs earlier, in the order
    of document id and line, so a repeated passage goes from its first to its last line. A copy
    within one document must begin after the first one ends. The first occurrence always stays.
    `lines_before` and `lines_removed` count lines.

    The shortest window of `run_words` words from each line on marks its smallest line hash as fingerprint, so every
    run long enough bears one at the same place wherever it stands. The places of fingerprints are joined; those that
    occur once are done with. Around each of the others the match is extended both ways, up to the lines that the runs
    through it can reach, and what lies left and right of it is compared by hash with the first place that has the same
    fingerprint and the same sides. Fingerprints and runs are only
    ever reduced to their first and last position, so a line in very many documents is not gathered anywhere.

    Null and empty texts and texts of fewer words come back unchanged, as do all other columns, whatever their
    names; input columns named as one of the two counts give way to it. Rows that repeat both id and text count as one
    document and are all treated alike; a null id comes after all others.
    """
    version, spans = "__llm_version", "__llm_spans"
    keyed = docs.withColumn(version, F.xxhash64(F.col(text_col).cast("string")))
    read = materialise(keyed.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit((1 << 63) - 1)).alias("doc_id"), F.col(version).alias("version"),
        F.col(text_col).cast("string").alias("text")).mapInArrow(lambda b: _fingerprinted(b, run_words), _LINES))
    places = read.select("doc_id", "version", F.explode("marks").alias("at"), "hashes").select(
        "doc_id", "version", "at", F.get("hashes", "at").alias("mark"))
    met = _repeated(materialise(places), ["mark"], F.struct("doc_id", "version", "at"), "doc_id", "version", "at")
    around = met.groupBy("doc_id", "version").agg(F.collect_set("at").alias("shared"))
    # Rows that repeat id and text are extended once.
    runs = materialise(read.drop("marks").dropDuplicates(["doc_id", "version"]).join(around, ["doc_id", "version"]).select(
        "doc_id", "version", "numbers", "hashes", "sizes", "shared").mapInArrow(lambda b: _extended(b, run_words), _RUNS))
    place = F.struct("doc_id", "version", "start", "stop")
    later = _repeated(runs, ["mark", "left", "right"], place, "doc_id", "version", "start", "stop")
    other = (F.col("doc_id") != F.col("first.doc_id")) | (F.col("version") != F.col("first.version"))
    repeated = later.where(other | (F.col("start") > F.col("first.stop"))).groupBy("doc_id", "version").agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias(spans))
    repeated = repeated.select(F.col("doc_id").alias("__llm_id"), F.col("version").alias("__llm_of"), spans)

    own = F.coalesce(F.col(id_col).cast("bigint"), F.lit((1 << 63) - 1))
    joined = keyed.join(repeated, (own == F.col("__llm_id")) & (F.col(version) == F.col("__llm_of")), "left")
    lines = F.split(F.col(text_col).cast("string"), "\n")
    kept = F.filter(lines, lambda line, i: ~_covered(F.col(spans), i))
    text = F.when(F.col(spans).isNull(), F.col(text_col).cast("string")).otherwise(F.array_join(kept, "\n"))
    before = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("bigint")
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in ("lines_before", "lines_removed")],
        before.alias("lines_before"),
        F.when(F.col(spans).isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(kept)).cast("bigint").alias("lines_removed"))


def _covered(spans: Column, line: Column) -> Column:
    return F.exists(spans, lambda span: (span["start"] <= line) & (line <= span["stop"]))

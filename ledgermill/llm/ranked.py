"""Ranked lexical search: documents grouped by the mask of an item's terms they hold, best masks first."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import materialise
from .arrays import BLANKS, LOWER, text_pieces, words

# Documents of an item's answer.
TOP = 50
# Items that are looked for in one pass over the documents' terms, and the most terms that they may have together.
ITEM_BLOCK, TERM_BLOCK = 2048, 1 << 20
# Documents whose masks are held at once.
DOC_BLOCK = 4096
# Parts in which an item's best documents are merged before the last merge.
MERGE_PARTS = 32

# Digits, ASCII letters and all that is not ASCII make terms.
_TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
_APART = BLANKS.copy()
_APART[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

_TERMS = "doc_id bigint, n bigint, terms array<bigint>, tfs array<bigint>"
_FOUND = "item bigint, doc_id bigint, score bigint"


def terms_of(text: str | None) -> list[str]:
    """Terms of a text in their order."""
    return _TERM.findall((text or "").translate(_UPPER))


def _hashes(terms: list[str]) -> np.ndarray:
    """The hash by which each term is found in documents."""
    data = " ".join(terms).encode()
    return words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), _APART, LOWER)[0]


def _counted(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Number of terms of each document, and which terms of the sorted vocabulary it holds how often."""
    for batch in batches:
        for first, last, data, offsets in text_pieces(batch.column(1)):
            hashes, before = words(data, offsets, _APART, LOWER)
            at = np.minimum(np.searchsorted(vocabulary, hashes), max(0, len(vocabulary) - 1))
            known = np.flatnonzero(vocabulary[at] == hashes) if len(vocabulary) else np.empty(0, np.int64)
            row = np.searchsorted(before, known, "right") - 1
            keys, tfs = np.unique(row * np.int64(max(1, len(vocabulary))) + at[known], return_counts=True)
            row, term = np.divmod(keys, max(1, len(vocabulary)))
            bounds = pa.array(np.searchsorted(row, np.arange(last - first + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, last - first), pa.array(np.diff(before)),
                pa.ListArray.from_arrays(bounds, pa.array(vocabulary[term].view(np.int64))),
                pa.ListArray.from_arrays(bounds, pa.array(tfs.astype(np.int64))),
            ], names=["doc_id", "n", "terms", "tfs"])


@dataclass
class Items:
    """A block of items: the number of each, the places of its terms in `vocabulary`, and the terms' weights."""

    numbers: np.ndarray
    terms: list[np.ndarray]
    vocabulary: np.ndarray
    weights: np.ndarray
    documents: int
    length: int


class _Best:
    """The best documents of one item so far."""

    def __init__(self, top: int) -> None:
        self.top, self.scores, self.ids = top, np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        best = np.lexsort((ids, -scores))[:self.top]
        self.scores, self.ids = scores[best], ids[best]

    def least(self) -> int:
        """No document with a lower score is wanted any more."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1


def _masks(rows: list[np.ndarray], documents: int) -> tuple[np.ndarray, np.ndarray]:
    """For each document the number of its mask, and for each mask its bits, one column per term.

    Bits are set in words of 64; masks of several words are numbered word by word.
    """
    number, masks = np.zeros(documents, np.int64), np.zeros((1, 0), bool)
    for begin in range(0, len(rows), 64):
        part = rows[begin:begin + 64]
        word = np.zeros(documents, np.uint64)
        for bit, holders in enumerate(part):
            word[holders] |= np.uint64(1 << bit)
        values, code = np.unique(word, return_inverse=True)
        both, number = np.unique(number * len(values) + code, return_inverse=True)
        before, code = np.divmod(both, len(values))
        bits = (values[code][:, None] >> np.arange(len(part), dtype=np.uint64)) & np.uint64(1)
        masks = np.concatenate([masks[before], bits.astype(bool)], axis=1)
    return number, masks


def _search_block(ids: np.ndarray, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, items: Items,
                  best: list[_Best]) -> None:
    """Let a block of documents take its places among the best of every item. `doc`, `term`, `tf`: its occurrences."""
    order = np.lexsort((doc, term))
    doc, term, tf = doc[order], term[order], tf[order]
    gain = items.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
    bounds = np.searchsorted(term, np.arange(len(items.vocabulary) + 1))
    most = np.zeros(len(items.vocabulary), np.int64)
    held = np.flatnonzero(np.diff(bounds))
    if not len(held):
        return
    most[held] = np.maximum.reduceat(gain, bounds[held])
    for own, found in zip(items.terms, best):
        own = own[most[own] > 0]
        if most[own].sum() < found.least():
            continue
        number, masks = _masks([doc[bounds[t]:bounds[t + 1]] for t in own], len(ids))
        highest = masks @ most[own]
        by_mask = np.argsort(number, kind="stable")
        starts = np.searchsorted(number[by_mask], np.arange(len(masks) + 1))
        ranked = np.argsort(-highest, kind="stable")
        done, least = 0, found.least()
        while done < len(ranked) and highest[ranked[done]] >= least:
            # Masks that are certainly needed: those in front until as many documents as an answer has are seen.
            sizes = np.cumsum(starts[ranked[done:] + 1] - starts[ranked[done:]])
            step = max(1, int(np.searchsorted(sizes, found.top)) + 1)
            chosen = ranked[done:done + step]
            chosen = chosen[highest[chosen] >= least]
            documents = np.sort(np.concatenate([by_mask[starts[k]:starts[k + 1]] for k in chosen]))
            scores = np.zeros(len(documents), np.int64)
            for t in own[masks[chosen].any(axis=0)]:
                holders, gains = doc[bounds[t]:bounds[t + 1]], gain[bounds[t]:bounds[t + 1]]
                at = np.minimum(np.searchsorted(holders, documents), len(holders) - 1)
                scores += np.where(holders[at] == documents, gains[at], 0)
            some = (scores > 0) & (scores >= least)
            if some.any():
                found.add(scores[some], ids[documents[some]])
            done += step
            least = found.least()


def _searched(batches: Iterator[pa.RecordBatch], items: Items, top: int) -> Iterator[pa.RecordBatch]:
    """The best documents of each item among the rows of a task.

    Blocks hold documents of like length, whose masks have close bounds; what is the least good score of an answer in
    one block is known in the next.
    """
    best = [_Best(top) for _ in items.numbers]
    for batch in batches:
        n = batch.column(1).to_numpy()
        m = 50 + (50 * n * items.documents) // max(1, items.length)
        ids = batch.column(0).fill_null((1 << 63) - 1).to_numpy()
        lists, tfs = batch.column(2), batch.column(3)
        doc = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
        hashes = lists.flatten().to_numpy().view(np.uint64)
        term = np.minimum(np.searchsorted(items.vocabulary, hashes), max(0, len(items.vocabulary) - 1))
        mine = items.vocabulary[term] == hashes
        doc, term, tf = doc[mine], term[mine], tfs.flatten().to_numpy()[mine]
        place = np.empty(len(n), np.int64)
        order = np.argsort(n, kind="stable")
        place[order] = np.arange(len(n))
        for begin in range(0, len(n), DOC_BLOCK):
            part = (place[doc] >= begin) & (place[doc] < begin + DOC_BLOCK)
            block = order[begin:begin + DOC_BLOCK]
            _search_block(ids[block], m[block], place[doc[part]] - begin, term[part], tf[part], items, best)
    for number, found in zip(items.numbers, best):
        if len(found.ids):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(found.ids), number)), pa.array(found.ids), pa.array(found.scores),
            ], names=["item", "doc_id", "score"])


def _best_of(found: DataFrame, top: int, *by: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("item", *by).orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= top)


def _item_blocks(benchmark: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Distinct items with a number and their terms, and spans of numbers that hold few enough items and terms."""
    read = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(text_col).cast("string").alias("text")).distinct()
    items = materialise(read.mapInArrow(_with_terms, "item_id bigint, terms array<string>").withColumn(
        "item", F.monotonically_increasing_id()))
    sizes = items.select("item", F.size("terms").alias("size")).orderBy("item")
    spans, begin, count, total, last = [], None, 0, 0, -1
    for row in sizes.toLocalIterator():  # two numbers an item
        if begin is not None and (count == ITEM_BLOCK or total + row["size"] > TERM_BLOCK):
            spans.append((begin, last))
            begin, count, total = None, 0, 0
        begin = row["item"] if begin is None else begin
        count, total, last = count + 1, total + row["size"], row["item"]
    return items, spans + ([(begin, last)] if begin is not None else [])


def _with_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(terms_of(text))) for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["item_id", "terms"])


def ranked_search(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", top: int = TOP) -> DataFrame:
    """The `top` documents of each item by weighted terms: `item_id`, `rank` from 1, `doc_id`, `score`.

    Terms are runs of digits, ASCII letters and all other letters and signs outside ASCII, with A-Z in lower case. A
    term's weight falls with the number of documents that hold it; a document gains from a term by its occurrences,
    less so the longer the document is. Whole numbers throughout, so the order of rows cannot change a score.

    Documents are read once per block of items (2,048 items with 2^20 terms at most): a document becomes its number of
    terms and the occurrences of the block's terms, and the counts of documents follow from these rows, which are
    written. In a second pass each task takes blocks of documents of like length. For each item the documents that
    hold a term set that term's bit in their masks, documents of one mask are a group, and a mask's highest score is
    the sum of the highest gains of its terms in the block. Masks are worked on by falling highest score until it is
    below the item's last place so far, which is carried from block to block; equal ones are still looked at, since a
    smaller id wins a tie. A task returns `top` rows for each item at most, and these are merged in parts first, so no
    document list is ever gathered.

    Null and empty texts have no terms; they count for nothing and are never found. Documents of score 0 are not
    found. Each row is a document of its own, also where rows repeat an id; a null id comes after all others of its
    score. An item without terms has no rows; items that repeat id and text count once, and of one id with two texts
    each is ranked by itself. Other columns are ignored, and without documents or items there are no rows. Terms are
    found by 64-bit hashes.
    """
    items, spans = _item_blocks(benchmark, item_col, item_text_col)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = [_search_items(texts, items.where(F.col("item").between(*span)), top) for span in spans]
    spark = docs.sparkSession
    whole = spark.createDataFrame([], _FOUND) if not found else found[0]
    for part in found[1:]:
        whole = whole.union(part)
    parts = _best_of(whole.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_PARTS))), top, "part")
    ranked = _best_of(parts.drop("rank", "part"), top)
    return ranked.join(items.select("item", "item_id"), "item").select(
        "item_id", "rank", F.nullif(F.col("doc_id"), F.lit((1 << 63) - 1)).alias("doc_id"), "score")


def _search_items(texts: DataFrame, block: DataFrame, top: int) -> DataFrame:
    """The best documents of each item of a block, of each task's rows."""
    rows = [(row["item"], row["terms"]) for row in block.collect() if row["terms"]]  # bounded by the block
    hashed = [np.unique(_hashes(terms)) for _, terms in rows]
    vocabulary = np.unique(np.concatenate([np.empty(0, np.uint64), *hashed]))
    spark = texts.sparkSession
    counted = materialise(_mapped(spark, texts, _counted, vocabulary, _TERMS))
    documents, length = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row for each term of the block.
    holders = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1))).collect())
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * holders.get(int(t), 0) + 1)))
                        for t in vocabulary.view(np.int64)], np.int64)
    items = Items(np.array([number for number, _ in rows], np.int64), [np.searchsorted(vocabulary, own) for own in hashed],
                  vocabulary, weights, documents, length)
    return materialise(_mapped(spark, counted.where("n > 0"), lambda b, i: _searched(b, i, top), items, _FOUND))


def _mapped(spark: SparkSession, df: DataFrame, function, argument, schema: str) -> DataFrame:
    """`function(batches, argument)` over `df`; the argument is sent to each executor once."""
    sent = spark.sparkContext.broadcast(argument)
    return df.mapInArrow(lambda batches: function(batches, sent.value), schema)

"""Language of each word by a linear-chain conditional random field, and of each text by its words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import code_points, letter_table, mark_table, mix, seeds, text_pieces

UNKNOWN = "und"
# Labelled rows the model is fitted on, at most, and the words taken from each.
FIT_ROWS, FIT_WORDS = 3000, 32
_BITS = 17
_BLOCK = 64
_PLACES = (seeds(8, 600) | np.uint64(1))
_KINDS = seeds(8, 650)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    """Labels, the weight of each hashed feature for each label, and the weight of each pair of neighbours."""

    labels: list[str]
    features: np.ndarray
    transitions: np.ndarray


def _laid_out(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters with 0 for all else and between rows, and where the rows begin."""
    points, offsets = code_points(data, offsets)
    sizes = np.diff(offsets)
    begins = offsets + 2 * np.arange(len(offsets))
    out = np.zeros(begins[-1] + 2, np.uint64)
    out[np.arange(len(points)) + np.repeat(2 * np.arange(len(sizes)) + 1, sizes)] = letter_table()[points]
    return out, begins


def _word_bounds(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff((letters != 0).astype(np.int8))
    return np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1


def _whole_words(letters: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word: its trigrams added up, each scaled by its place."""
    values = mix(letters + np.uint64(1))
    place = np.arange(len(letters), dtype=np.uint64)
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    weighted = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * place)])
    total = running[ends] - running[begins]
    turned = weighted[ends] - weighted[begins] - begins.astype(np.uint64) * total
    pairs = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values[:-1] * _PLACES[0] + values[1:]))])
    return mix(total * _PLACES[1] + turned * _PLACES[2] + (pairs[ends - 1] - pairs[begins]) * _PLACES[3])


def _features(letters: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hash buckets of words: one array for each affix and for the word itself, then the trigrams of all words, edges
    included, and where those of each word begin."""
    shift = np.uint64(64 - _BITS)
    bucket = lambda value, kind: (mix(value ^ _KINDS[kind]) >> shift).astype(np.int64)
    single = [bucket(_whole_words(letters, begins, ends), 0)]
    size = ends - begins
    front, back = np.zeros(len(begins), np.uint64), np.zeros(len(begins), np.uint64)
    for k in range(3):
        have = size > k
        front = np.where(have, front + letters[np.minimum(begins + k, ends - 1)] * _PLACES[k], front)
        back = np.where(have, back + letters[np.maximum(ends - 1 - k, begins)] * _PLACES[k], back)
        single += [bucket(front, 1 + k), bucket(back, 4 + k)]
    starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
    at = np.arange(starts[-1]) - np.repeat(starts[:-1], size) + np.repeat(begins, size) - 1
    grams = bucket(letters[at] * _PLACES[4] + letters[at + 1] * _PLACES[5] + letters[at + 2] * _PLACES[6], 7)
    return single, grams, starts


def _emissions(model: Model, letters: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Weight of each label for each word; equal words are computed once."""
    _, first, which = np.unique(_whole_words(letters, begins, ends), return_index=True, return_inverse=True)
    single, grams, starts = _features(letters, begins[first], ends[first])
    total = np.add.reduceat(model.features[grams], starts[:-1], axis=0)
    for buckets in single:
        total += model.features[buckets]
    return total[which]


def _marginals(emissions: np.ndarray, transitions: np.ndarray, first_word: np.ndarray) -> np.ndarray:
    """Sum over the words of each row of the probability of each label, by forward-backward over the whole row.

    Rows are cut into blocks. The product of the steps of every block, a small matrix, is computed for all blocks at
    once; running over the products of a row gives what enters each block from both ends, exactly.
    """
    labels = emissions.shape[1]
    size = np.diff(first_word)
    blocks = -(-size // _BLOCK)
    first_block = np.concatenate([np.zeros(1, np.int64), np.cumsum(blocks)])
    row_of = np.repeat(np.arange(len(size)), blocks)
    number = np.arange(first_block[-1]) - first_block[row_of]
    word = (first_word[row_of] + number * _BLOCK)[:, None] + np.arange(_BLOCK)
    valid = word < first_word[row_of + 1][:, None]
    word = np.minimum(word, len(emissions) - 1)
    step = np.exp(emissions - emissions.max(axis=1, keepdims=True))[word]
    pair = np.exp(transitions - transitions.max())
    opening = (number == 0)[:, None]

    def forward(rows: np.ndarray, j: int) -> np.ndarray:
        """Rows of weights (block, any, label) after word j of each block."""
        moved = rows @ pair
        if not j:
            moved = np.where(opening[:, None], rows, moved)
        moved *= step[:, j, None, :]
        moved /= moved.max(axis=(1, 2), keepdims=True) + 1e-300
        return np.where(valid[:, j, None, None], moved, rows)

    product = np.broadcast_to(np.eye(labels), (len(row_of), labels, labels)).copy()
    for j in range(_BLOCK):
        product = forward(product, j)

    entering = np.full((len(row_of), 1, labels), 1.0)
    leaving = np.full((len(row_of), labels), 1.0)
    for i in range(1, int(blocks.max(initial=0))):
        at = first_block[:-1][blocks > i] + i
        after = (entering[at - 1] @ product[at - 1])
        entering[at] = after / after.max(axis=2, keepdims=True)
        at = first_block[1:][blocks > i] - 1 - i
        before = np.einsum("bij,bj->bi", product[at + 1], leaving[at + 1])
        leaving[at] = before / before.max(axis=1, keepdims=True)

    ahead = np.empty((len(row_of), _BLOCK, labels))
    state = entering
    for j in range(_BLOCK):
        state = forward(state, j)
        ahead[:, j] = state[:, 0]
    total = np.zeros((len(row_of), labels))
    behind = leaving
    for j in range(_BLOCK - 1, -1, -1):
        both = ahead[:, j] * behind
        total += np.where(valid[:, j, None], both / both.sum(axis=1, keepdims=True), 0)
        back = (step[:, j] * behind) @ pair.T
        back /= back.max(axis=1, keepdims=True) + 1e-300
        behind = np.where(valid[:, j, None], back, behind)
    out = np.zeros((len(size), labels))
    np.add.at(out, row_of, total)
    return out


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        fit_rows: int = FIT_ROWS, fit_words: int = FIT_WORDS, rounds: int = 60) -> Model:
    """Fit on at most `fit_rows` rows with a language, the first in the order of their id's hash.

    `fit_words` consecutive words are taken from each, at a place their hash decides. Words bear the language of
    their row. Passages of different rows are strung together, so that the model sees text that switches between
    languages and learns how rarely it does. Rows without letters are left out; without rows no language is known.
    """
    keyed = labelled.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"),
                            F.col(lang_col).cast("string").alias("lang")).where("lang IS NOT NULL AND key IS NOT NULL")
    hashed = F.xxhash64(F.col("key").cast("string"))
    chosen = keyed.select("key", hashed.alias("place")).orderBy("place", "key").limit(fit_rows).select("key").distinct()

    def passages(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cut = []
            for text, place in zip(frame["text"], frame["place"]):
                words = _WORD.findall(text or "")
                begin = place % max(1, len(words) - fit_words + 1)
                cut.append(" ".join(words[begin:begin + fit_words]))
            yield frame[["place", "lang"]].assign(text=cut)

    sample = keyed.join(F.broadcast(chosen), "key").select(hashed.alias("place"), "lang", "text").mapInPandas(
        passages, "place bigint, lang string, text string").where("text != ''")
    # Cut by executors, one partition at the end: a limit that is collected itself would send each partition's rows here.
    sample = sample.orderBy("place", "lang", "text").limit(fit_rows).coalesce(1).toPandas().sort_values(["place", "lang", "text"])
    labels = sorted(sample["lang"].unique())
    features = np.zeros((1 << _BITS, len(labels)), np.float32)
    transitions = np.zeros((len(labels), len(labels)))
    if len(labels) < 2:
        return Model(labels, features, transitions)

    texts = pa.array(sample["text"], pa.string())
    truth, letters_of, bounds, offset = [], [], [], 0
    for first, _, data, offsets in text_pieces(texts):
        letters, begins = _laid_out(data, offsets)
        word = _word_bounds(letters)
        row = first + np.searchsorted(begins, word[0], "right") - 1
        truth.append(sample["lang"].map(labels.index).to_numpy()[row])
        letters_of.append(letters)
        bounds.append((word[0] + offset, word[1] + offset))
        offset += len(letters)
    truth = np.concatenate(truth)
    begins, ends = (np.concatenate(x) for x in zip(*bounds))
    single, grams, starts = _features(np.concatenate(letters_of), begins, ends)
    sizes = np.diff(starts)
    columns = np.concatenate([*single, grams])
    rows = np.concatenate([*[np.arange(len(truth))] * len(single), np.repeat(np.arange(len(truth)), sizes)])
    return Model(labels, *_learn(rows, columns, truth, len(labels), rounds))


def _learn(rows: np.ndarray, columns: np.ndarray, truth: np.ndarray, labels: int, rounds: int,
           length: int = 96, penalty: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Maximise the likelihood of the labels of strung words with adaptive gradient steps."""
    n = len(truth) - len(truth) % length
    if not n:
        n = length = len(truth)
    inside = rows < n
    rows, columns, truth = rows[inside], columns[inside], truth[:n]
    used, columns = np.unique(columns, return_inverse=True)
    target = np.eye(labels)[truth].reshape(-1, length, labels)
    seen = np.einsum("sti,stj->ij", target[:, :-1], target[:, 1:])
    weights, pairs = np.zeros((len(used), labels)), np.zeros((labels, labels))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, pairs)]
    for t in range(1, rounds + 1):
        emissions = np.stack([np.bincount(rows, weights[columns, k], n) for k in range(labels)], axis=1)
        step = np.exp(emissions - emissions.max(axis=1, keepdims=True)).reshape(-1, length, labels)
        pair = np.exp(pairs)
        ahead, behind = np.empty_like(step), np.empty_like(step)
        ahead[:, 0], behind[:, -1] = step[:, 0], 1
        for j in range(1, length):
            ahead[:, j] = (ahead[:, j - 1] @ pair) * step[:, j]
            ahead[:, j] /= ahead[:, j].sum(axis=1, keepdims=True)
        for j in range(length - 2, -1, -1):
            behind[:, j] = (step[:, j + 1] * behind[:, j + 1]) @ pair.T
            behind[:, j] /= behind[:, j].sum(axis=1, keepdims=True)
        both = ahead * behind
        gap = (both / both.sum(axis=2, keepdims=True) - target).reshape(n, labels)
        joint = ahead[:, :-1, :, None] * pair * (step * behind)[:, 1:, None, :]
        joint /= joint.sum(axis=(2, 3), keepdims=True)
        slopes = (
            np.stack([np.bincount(columns, gap[rows, k], len(used)) for k in range(labels)], axis=1) + penalty * n * weights,
            joint.sum(axis=(0, 1)) - seen,
        )
        for value, slope, moment in zip((weights, pairs), slopes, moments):
            moment[0] = 0.9 * moment[0] + 0.1 * slope
            moment[1] = 0.99 * moment[1] + 0.01 * slope ** 2
            value -= 0.1 * (moment[0] / (1 - 0.9 ** t)) / (np.sqrt(moment[1] / (1 - 0.99 ** t)) + 1e-8)
    features = np.zeros((1 << _BITS, labels), np.float32)
    features[used] = weights
    return features, pairs


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """`doc_id`, `lang_pred` and `score` of every row, from its whole text, then the columns named in `keep`.

    Every word gets a probability for each language given all words of its text; the text gets the language with the
    most words, and as score their share. Texts that are null, empty or without a letter (marks that combine are none) are `und` with score 0; ties
    go to the first language by name. Each row is judged on its own, so ids may be null or repeated. Other columns
    are ignored; a kept column may not bear the name of one of the three.
    """
    kept = [docs.schema[c] for c in keep]
    names = np.array([*model.labels, UNKNOWN], dtype=object)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_pieces(batch.column(1)):
                best, share = np.full(last - first, len(names) - 1), np.zeros(last - first)
                letters, begins = _laid_out(data, offsets)
                word = _word_bounds(letters)
                if len(word[0]) and model.labels:
                    first_word = np.searchsorted(word[0], begins)
                    total = _marginals(_emissions(model, letters, *word), model.transitions, first_word)
                    real = np.concatenate([np.zeros(1, np.int64), np.cumsum((letters > 0) & ~mark_table()[letters])])
                    some = np.diff(real[begins]) > 0
                    best[some] = total[some].argmax(axis=1)
                    share[some] = np.clip(total[some].max(axis=1) / np.diff(first_word)[some], 0, 1)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), pa.array(names[best], pa.string()), pa.array(share),
                    *(column.slice(first, last - first) for column in batch.columns[2:]),
                ], names=["doc_id", "lang_pred", "score", *keep])

    schema = T.StructType.fromDDL("doc_id bigint, lang_pred string, score double")
    return docs.select(F.col(id_col).cast("bigint").alias("__id"), F.col(text_col).cast("string").alias("__text"),
                       *[F.col(f"`{c}`") for c in keep]).mapInArrow(predicted, T.StructType([*schema.fields, *kept]))

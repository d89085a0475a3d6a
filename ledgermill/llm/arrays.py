"""Words and shingles of Arrow text columns, computed with numpy over the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text and rows that are worked on at once. One longer text is a piece of its own.
PIECE_BYTES, PIECE_ROWS = 1 << 20, 4096

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """`n` fixed 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _BASE + np.uint64(salt))


_BYTE_VALUES = seeds(256, 17)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def text_pieces(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split a string column into runs of up to `PIECE_ROWS` rows of about `PIECE_BYTES`.

    Yields the first row, the row after the last, the bytes, and the offsets of the rows in them. Null counts as empty.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32, n + 1, texts.offset * 4).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    if texts.null_count:  # a null may cover bytes
        filled = texts.fill_null("")
        yield from text_pieces(filled)
        return
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE_BYTES, "right")) - 1)
        last = min(last, n, first + PIECE_ROWS)
        own = offsets[first:last + 1]
        yield first, last, data[own[0]:own[-1]], own - own[0]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANKS,
          lower: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the number of words before each row (one more than rows).

    Long data are worked on in parts that end between words, so memory is a small multiple of the words.
    """
    all_begins, all_hashes, done = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
    while done < len(data):
        until = _between_words(data, done + 2 * PIECE_BYTES, blank)
        part = data[done:until]
        inside = ~blank[part]
        row_start = np.zeros(len(part) + 1, bool)
        low, high = np.searchsorted(offsets, (done, until))
        row_start[offsets[low:high] - done] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | row_start[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | row_start[1:-1]
        begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        power, inverse = _power_tables(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[lower[part]] * power[:len(part)], out=total[1:])
        all_hashes.append(mix((total[ends] - total[begins]) * inverse[begins] + (ends - begins).astype(np.uint64)))
        all_begins.append(begins + done)
        done = until
    return np.concatenate(all_hashes), np.searchsorted(np.concatenate(all_begins), offsets)


def _between_words(data: np.ndarray, at: int, blank: np.ndarray) -> int:
    """The first place from `at` on that is blank, or the end."""
    while at < len(data):
        found = np.flatnonzero(blank[data[at:at + PIECE_BYTES]])
        if len(found):
            return at + int(found[0])
        at += PIECE_BYTES
    return len(data)


_PLACES = seeds(64, 23) | np.uint64(1)


def shingles(hashes: np.ndarray, first_word: np.ndarray, width: int) -> list[np.ndarray]:
    """For each row the sorted hashes of its distinct runs of `width` words.

    A row with fewer words has all of them as its one shingle; a row without words has none.
    """
    if len(hashes) >= width:
        n = len(hashes) - width + 1
        runs = np.zeros(n, np.uint64)
        for j in range(width):
            runs += hashes[j:j + n] * _PLACES[j]
        runs = mix(runs)
    out = []
    for begin, end in zip(first_word[:-1].tolist(), first_word[1:].tolist()):
        size = end - begin
        if size >= width:
            out.append(np.unique(runs[begin:end - width + 1]))
        elif size:
            short = (hashes[begin:end] * _PLACES[:size]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(short + np.uint64(width - size)))
        else:
            out.append(hashes[:0])
    return out


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The shingles of each row, piece by piece, with the number of the piece's first row."""
    for first, _, data, offsets in text_pieces(texts):
        yield first, shingles(*words(data, offsets), width)


def list_column(values: np.ndarray) -> pa.Array:
    """A list column from a matrix with one row per list."""
    rows, width = values.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, (rows + 1) * width, width, dtype=np.int32)), pa.array(values.ravel()),
    )


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unicode code points of the rows of a piece and their offsets. Malformed bytes become U+FFFD."""
    try:
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        before = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=before[1:])
        return points, before[offsets]
    except UnicodeDecodeError:
        rows = [data[i:j].tobytes().decode(errors="replace").encode("utf-32-le")
                for i, j in zip(offsets[:-1], offsets[1:])]
        sizes = np.array([0, *(len(row) // 4 for row in rows)], np.int64)
        return np.frombuffer(b"".join(rows), np.uint32), np.cumsum(sizes)


_tables: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is no letter. Marks that combine count as letters."""
    if "letters" not in _tables:
        import unicodedata

        table = np.zeros(0x110000, np.uint32)
        for i in (*range(0xD800), *range(0xE000, 0x110000)):
            c = chr(i)
            if c.isalpha() or unicodedata.category(c)[0] == "M":
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _tables["letters"] = table
    return _tables["letters"]


def mark_table() -> np.ndarray:
    """Which code points are marks that combine with a letter, and no letters by themselves."""
    if "marks" not in _tables:
        import unicodedata

        table = np.zeros(0x110000, bool)
        for i in (*range(0xD800), *range(0xE000, 0x110000)):
            table[i] = unicodedata.category(chr(i))[0] == "M"
        _tables["marks"] = table
    return _tables["marks"]

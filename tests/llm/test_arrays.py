import numpy as np
import pyarrow as pa

from ledgermill.llm.arrays import code_points, shingle_sets, text_pieces, words


def sets(texts, width):
    return [len(s) for _, part in shingle_sets(pa.array(texts, pa.string()), width) for s in part]


def test_words_are_split_and_folded_like_plain_python():
    texts = ["Ab  ab\tAB\n", "", None, "é É ab", "x" * 3000, " ", "ab"]
    array = pa.array(texts, pa.string())
    (_, _, data, offsets), = text_pieces(array)
    hashes, first = words(data, offsets)
    counts = np.diff(first).tolist()
    assert counts == [len((t or "").encode().split()) for t in texts]
    flat = [w.lower() if w.isascii() else w for t in texts for w in (t or "").split()]
    assert len({h for h in hashes.tolist()}) == len(set(flat))
    for a in range(len(flat)):
        for b in range(len(flat)):
            assert (hashes[a] == hashes[b]) == (flat[a] == flat[b])


def test_long_texts_are_hashed_in_parts_alike():
    words_of = [f"w{i % 5000}" for i in range(900_000)]
    texts = [" ".join(words_of), "x" * 5_000_000 + " tail", "w1 tail"]
    found = []
    for first, last, data, offsets in text_pieces(pa.array(texts)):
        hashes, first_word = words(data, offsets)
        found += [hashes[a:b] for a, b in zip(first_word[:-1], first_word[1:])]
    assert [len(f) for f in found] == [900_000, 2, 2]
    assert (found[0][:5000] == found[0][-5000:]).all() and len(set(found[0].tolist())) == 5000
    assert found[0][1] == found[2][0] and found[1][1] == found[2][1]


def test_shingles_of_short_empty_and_repeating_texts():
    assert sets(["a b c d e", "a b c", "", None, "a a a a a a", "   "], 4) == [2, 1, 0, 0, 1, 0]
    one = [s.tolist() for _, part in shingle_sets(pa.array(["a b c", "c b a", "a b c d"]), 4) for s in part]
    assert len({tuple(s) for s in one}) == 3


def test_rows_of_a_slice_and_of_many_pieces_keep_their_words():
    texts = [f"word{i} and {i} more" * 40 for i in range(3000)]
    array = pa.array(texts).slice(7, 2500)
    seen = 0
    for first, part in shingle_sets(array, 3):
        assert first == seen and len(part) <= 4096
        seen += len(part)
    assert seen == 2500
    again = [s.tolist() for _, part in shingle_sets(pa.array([texts[8]]), 3) for s in part]
    assert [s.tolist() for _, part in shingle_sets(array, 3) for s in part][1] == again[0]


def test_malformed_bytes_become_replacement_characters():
    data = np.frombuffer("aé".encode() + b"\xff" + b"b", np.uint8)
    points, offsets = code_points(data, np.array([0, 4, 5]))
    assert [chr(c) for c in points] == ["a", "é", "�", "b"] and offsets.tolist() == [0, 3, 4]

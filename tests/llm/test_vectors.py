import numpy as np

from ledgermill.llm import vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, cell int, links string, members int"


def brute(rows, threshold=0.93):
    def usable(v, label):
        return label is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = [0] * len(rows)
    component = {i: i for i, _, _ in rows if i is not None}
    links = []
    for a, (i, v, x) in enumerate(rows):
        for b, (j, w, y) in enumerate(rows):
            if a != b and i is not None and j is not None and usable(v, x) and usable(w, y) and x == y and len(v) == len(w):
                p, q = (np.array(u, np.float32).astype(float) for u in (v, w))
                if p @ q / np.linalg.norm(p) / np.linalg.norm(q) >= threshold:
                    n[a] += 1
                    links.append((i, j))
    for _ in rows:
        for i, j in links:
            component[i] = component[j] = min(component[i], component[j])
    return sorted(((i, n[a], component.get(i), i is None or component[i] == i) for a, (i, _, _) in enumerate(rows)), key=repr)


def found(spark, rows):
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in vectors.near_duplicate_vectors(table).collect()), key=repr)


def sample(rng, groups, dims=64):
    rows = []
    for _ in range(groups):
        centre = rng.normal(size=dims)
        for _ in range(int(rng.integers(1, 5))):
            rows.append((centre + rng.normal(size=dims) * rng.choice([0.02, 0.15, 0.3])).tolist())
    return rows


def test_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LIST_ROWS", 16)
    monkeypatch.setattr(vectors, "TILE_ROWS", 8)
    rng = np.random.default_rng(2)
    rows = [(i, v, int(i % 3)) for i, v in enumerate(sample(rng, 60))]
    rows += [(500 + i, rows[4][1], rows[4][2]) for i in range(20)]  # copies
    rows += [(600, [2 * x for x in rows[4][1]], rows[4][2]), (601, rows[4][1], None), (602, None, 1), (603, [], 1), (604, [0.0] * 64, 1),
             (605, [float("nan")] * 64, 1), (606, [None] * 64, 1), (607, [float("inf")] + [1.0] * 63, 1), (608, [1.0, 2.0], 1),
             (609, [1.0, 2.1], 1), (None, rows[4][1], rows[4][2]), (610, rows[9][1], rows[9][2]), (610, rows[9][1], rows[9][2])]
    assert found(spark, rows) == brute(rows)


def test_recall_over_many_lists(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LIST_ROWS", 50)
    rng = np.random.default_rng(4)
    rows = [(i, v, 1) for i, v in enumerate(sample(rng, 400))]
    got, expected = found(spark, rows), brute(rows)
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in expected)
    assert all(a[1] <= b[1] for a, b in zip(got, expected))


def test_no_usable_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, 1), (2, [1.0], None)]) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_coded_distances_bound_the_true_ones():
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(300, 16))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    index = vectors.Index.fit(rows, 5)
    cells, codes, missing = index.encode(rows)
    for cell in range(5):
        inside = cells == cell
        coded = index.distances(rows, cell, codes[inside])
        true = np.linalg.norm(rows[:, None] - rows[inside][None], axis=2)
        assert (np.abs(coded - true) <= missing[inside] + 1e-3).all()


def test_both_ends_of_a_link_count_it_also_with_many_lists(spark):
    """Clustered vectors of few directions, cut into many lists: recall and symmetry of the counts."""
    rng = np.random.default_rng(11)
    flat = rng.normal(size=(4, 24))
    rows = np.concatenate([rng.normal(size=(40, 4))[i % 40] + 0.12 * rng.normal(size=(1, 4)) for i in range(1200)]) @ flat
    table = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>, label int")
    units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    near = units @ units.T >= 0.93
    np.fill_diagonal(near, False)
    got = {r.vec_id: r.n_links for r in vectors.near_duplicate_vectors(table).collect()}
    links = np.array([got[i] for i in range(len(rows))])
    assert links.sum() >= 0.9 * near.sum() and (links <= near.sum(1)).all()
    assert links.sum() % 2 == 0


def test_lists_of_several_levels_lose_nothing_at_full_margin(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LIST_ROWS", 8)
    monkeypatch.setattr(vectors, "MOST_LISTS", 4)
    rng = np.random.default_rng(8)
    rows = [(i, v, 1) for i, v in enumerate(sample(rng, 30))]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    got = vectors.near_duplicate_vectors(table, margin=1.0).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_recall_over_lists_of_several_levels(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LIST_ROWS", 8)
    monkeypatch.setattr(vectors, "MOST_LISTS", 8)
    rng = np.random.default_rng(9)
    rows = [(i, v, 1) for i, v in enumerate(sample(rng, 60))]
    got, expected = found(spark, rows), brute(rows)
    assert sum(r[1] for r in got) >= 0.95 * sum(r[1] for r in expected)
    assert all(a[1] <= b[1] for a, b in zip(got, expected)) and sum(r[1] for r in got) % 2 == 0


def test_probes_hold_every_list_with_a_near_vector():
    rng = np.random.default_rng(10)
    rows = np.concatenate([c + 0.1 * rng.normal(size=(30, 16)) for c in rng.normal(size=(20, 16))])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    index = vectors.Index.fit(rows, 400, 8)
    assert len(index.levels) == 3 and index.code_words.shape[0] == 8
    cells, _, _ = index.encode(rows)
    probed = index.probes(rows, 0.3)
    near = np.linalg.norm(rows[:, None] - rows[None], axis=2) <= 0.3
    for row, lists in enumerate(probed):
        assert len(set(lists)) == len(lists) and set(cells[near[row]]) <= set(lists)
    assert len(set(cells)) > 8  # more than one level has
    centres = np.array([index.centre(int(c)) for c in cells])
    assert np.linalg.norm(rows - centres, axis=1).mean() < np.linalg.norm(rows - index.levels[0][vectors._nearest(rows, index.levels[0])], axis=1).mean()

"""Links, groups and counts against all pairs."""

import numpy as np

from rivertally.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, cell int"


def expected(vectors):
    """Number of links and smallest identifier of the group, for vectors with a direction."""
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    label = np.array(ids)
    for _ in ids:
        label = np.minimum(label, np.where(link, label[None, :], 1 << 40).min(axis=1))
    return {i: (int(link[k].sum()), int(label[k])) for k, i in enumerate(ids)}


def clustered(seed, n, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 6, dim))
    x = centres[rng.integers(0, len(centres), n)] + 0.22 * rng.standard_normal((n, dim))
    x[::17] = x[0]  # equal ones
    x[1::40] = x[1] + 0.01 * rng.standard_normal((len(x[1::40]), dim))  # a dense group
    return {int(i): v.astype(np.float32).astype(float).tolist() for i, v in zip(rng.permutation(5 * n)[:n], x, strict=True)}


def check(spark, vectors):
    frame = spark.createDataFrame([(i, v, 0, 0, 0) for i, v in vectors.items()], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.embedding_groups(frame).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in expected(vectors).items()}


def test_against_all_pairs(spark):
    vectors = clustered(1, 600)
    assert sum(n for n, _ in expected(vectors).values()) > 100
    check(spark, vectors)


def test_pieces_of_large_cells(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 40)
    monkeypatch.setattr(embeddings, "MOST_CELLS", 5)
    check(spark, clustered(2, 500))


def test_pieces_of_owners_meet_pieces_of_visitors(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    monkeypatch.setattr(embeddings, "fit_centres", lambda x, cells: np.eye(8)[:2] + 0.01)
    check(spark, clustered(4, 300))


def test_doubles_are_compared_as_doubles(spark):
    # As floats, these two would be one vector.
    rows = [(1, [1.0, 1.0]), (2, [1.0, 1.0 + 2.0**-40]), (3, [1.0, -1.0])]
    got = embeddings.embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]
    stay = embeddings.representatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(r.vec_id for r in stay) == [1, 3]


def test_any_centres_will_do(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "fit_centres", lambda x, cells: np.eye(8)[: min(8, len(x))])
    check(spark, clustered(3, 300))


def test_rows_without_a_direction(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v), (2, [2.0, 4.0, 6.0]), (2, [2.0, 4.0, 6.0]),  # a repeated row
        (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]), (7, [1.0, float("nan"), 3.0]), (8, [float("inf"), 1.0, 1.0]),
        (9, v), (9, [3.0, 2.0, 1.0]),  # names two vectors
        (10, v), (10, None),
        (None, v), (None, v), (11, [1.0, 2.0, 3.0, 0.0]), (12, [1.0, 2.0, 3.0, 0.0]), (13, v),
    ]
    frame = spark.createDataFrame([(i, x, 0, 0, 0) for i, x in rows], SCHEMA)
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.embedding_groups(frame).collect()]
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10)]  # 9 and 10 by their other vector
    same = [(i, 7, 1, i == 1) for i in (1, 2, 2, 9, 10, None, None, 13)]
    assert sorted(got, key=str) == sorted([*alone, *same, (11, 1, 11, True), (12, 1, 11, False)], key=str)
    stay = sorted((r.vec_id, r.embedding) for r in embeddings.representatives(frame).where("vec_id in (1, 2, 9, 10, 13)").collect())
    assert stay == [(1, v), (9, [3.0, 2.0, 1.0]), (10, None)]


def test_groups_without_identifiers(spark):
    v, w = [1.0, 2.0, 3.0], [-3.0, 1.0, 0.0]
    frame = spark.createDataFrame([(i, x, 0, 0, 0) for i, x in [(None, v), (None, v), (5, w), (4, w), (5, v[::-1])]], SCHEMA)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.embedding_groups(frame).collect()), key=str)
    assert got == sorted([(None, 1, None, False), (None, 1, None, False), (5, 1, 4, False), (4, 1, 4, True), (5, 0, 5, True)], key=str)


def test_empty(spark):
    assert embeddings.embedding_groups(spark.createDataFrame([], SCHEMA)).count() == 0

"""Vector dedup and search against brute force."""

import numpy as np
import pytest

from tickloom.llm import vector_dedup, vector_search, vectors
from tickloom.llm.queries import QUERIES

ODD = [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [1.0, None] + [0.0] * 6), (1004, [float("nan")] * 8), (1005, [float("inf")] + [1.0] * 7), (1006, [1.0, 2.0]), (None, [1.0] * 8)]


def made(spark, x, odd=(), ids=None):
    ids = range(len(x)) if ids is None else ids
    rows = [(int(i), v.tolist(), 0, 1, 0.5) for i, v in zip(ids, x)] + [(i, v, None, 1, 0.5) for i, v in odd]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n long, score double")


def groups(seed, n=300, width=8):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, width))
    for k in range(0, n, 3):  # near copies at many distances, chains among them
        x[k + 1] = x[k] + rng.standard_normal(width) * rng.choice([0.05, 0.1, 0.15, 0.3])
    x[200:260] = x[7]  # one very common vector
    x[260:280] = 3 * x[9]
    return x


def test_links_and_components(spark):
    x = groups(1)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (u @ u.T >= vector_dedup.COSINE) & ~np.eye(len(x), dtype=bool)
    a, b = np.nonzero(linked)
    label = vector_dedup._forest(a, b, len(x))
    rows = vector_dedup.near_vectors(made(spark, x, ODD), recall=1.0).collect()
    assert len(rows) == len(x) + len(ODD)
    got = {r["vec_id"]: r for r in rows}
    for k in range(len(x)):
        assert (got[k]["n_links"], got[k]["component_id"]) == (linked[k].sum(), label[k])
        assert got[k]["kept"] == (label[k] == k)
    for i, _ in ODD[:-1]:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[None]["component_id"] is None and got[None]["kept"] and got[None]["n_links"] == 0


def test_small_blocks_give_the_same(spark, monkeypatch):
    df = made(spark, groups(2))
    want = sorted(vector_dedup.near_vectors(df, recall=1.0).collect())
    monkeypatch.setattr(vector_dedup, "BLOCK_ROWS", 32)
    assert sorted(vector_dedup.near_vectors(df, recall=1.0).collect()) == want


def test_traversal_visits_nearest_cells_first():
    rng = np.random.default_rng(3)
    index = vector_dedup.MultiIndex(rng.standard_normal((7, 4)), rng.standard_normal((5, 4)))
    x = rng.standard_normal((20, 8))
    a, b = index.halves(x)
    order = index.visited(x, 35)
    for row in range(20):
        total = (a[row][:, None] + b[row][None]).ravel()
        assert sorted(order[row]) == list(range(35))
        assert (np.diff(total[order[row]]) >= -1e-12).all()
        assert order[row][0] == index.cells(x)[row]


def test_tables_without_usable_vectors(spark):
    for rows in ([], ODD[:6]):
        df = made(spark, np.zeros((0, 8)), rows)
        assert len(vector_dedup.near_vectors(df).collect()) == len(rows)
        assert vector_search.nearest_vectors(df).collect() == []


def brute(ids, x, every, nearest):
    out = {}
    for k, i in enumerate(ids):
        if i % every == 0:
            score = (x * x[k]).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if j != k][:nearest]
            out[i] = [(int(ids[j]), score[j]) for j in order]
    return out


@pytest.mark.parametrize("scale", [False, True])
def test_search_recall_scores_and_ties(spark, scale):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 16))
    x = x if scale else x / np.linalg.norm(x, axis=1, keepdims=True)
    x[300:400] = x[0]  # many ties for the first query
    ids = rng.permutation(4000)[:1500]
    rows = vector_search.nearest_vectors(made(spark, x, ODD[:6], ids), every=20).collect()
    want, place = brute(ids, x, 20, 20), {int(i): k for k, i in enumerate(ids)}
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    for q, found in got.items():
        assert all(s == (x[place[q]] * x[place[i]]).sum() for i, s in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))


def test_search_with_few_rows_gives_all(spark):
    x = np.random.default_rng(6).standard_normal((7, 4))
    rows = vector_search.nearest_vectors(made(spark, x), every=1).collect()
    assert len(rows) == 7 * 6


def test_search_over_split_lists(spark, monkeypatch):
    x = groups(7, 600, 6)
    df = made(spark, x)
    want = sorted(vector_search.nearest_vectors(df, every=10).collect())
    for name in ("BLOCK_ROWS", "LEAST_BLOCK"):
        monkeypatch.setattr(vector_search, name, 50)
    assert sorted(vector_search.nearest_vectors(df, every=10).collect()) == want


def test_recall_on_the_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    want = brute(ids, x, 20, 20)
    got = {}
    for r in QUERIES["op6_nearest_neighbours"](spark, sf_dir).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sum(len({i for i, _ in want[q]} & got[q]) for q in want) >= 0.9 * 20 * len(want)


def test_usable_takes_every_length(spark):
    df = made(spark, np.ones((3, 8)), ODD)
    assert {r["id"] for r in vectors.usable(df).collect()} == {0, 1, 2, 1006}


@pytest.mark.parametrize("small", [vectors.SMALL_ROWS, 100])
def test_each_length_is_a_collection(spark, monkeypatch, small):
    monkeypatch.setattr(vectors, "SMALL_ROWS", small)
    long, short = groups(1), groups(2, 282, 5)
    odd = [(5000 + i, v.tolist()) for i, v in enumerate(short)] + [(7000 + i, [3.0, 4.0, 5.0]) for i in range(5)]
    df = made(spark, long, odd + ODD[:6])
    got = {r["vec_id"]: r for r in vector_dedup.near_vectors(df, recall=1.0).collect()}
    for start, x in ((0, long), (5000, short), (7000, np.array([[3.0, 4.0, 5.0]] * 5))):
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        linked = (u @ u.T >= vector_dedup.COSINE) & ~np.eye(len(x), dtype=bool)
        label = vector_dedup._forest(*np.nonzero(linked), len(x))
        for k in range(len(x)):
            assert (got[start + k]["n_links"], got[start + k]["component_id"]) == (linked[k].sum(), start + label[k])
    found = {}
    for r in vector_search.nearest_vectors(df).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for start, x in ((0, long), (5000, short), (7000, np.array([[3.0, 4.0, 5.0]] * 5))):
        for q, want in brute(start + np.arange(len(x)), x, 20, 20).items():
            assert len(found[q]) == len(want) and all(start <= i < start + len(x) for _, i, _ in found[q])
            hits += len({i for i, _ in want} & {i for _, i, _ in found[q]})
            total += len(want)
    assert hits >= 0.9 * total and not {q for q in found if q >= 1000} - {q for q in range(5000, 7005)}


def test_single_precision_gives_the_same(spark):
    x = groups(3).astype(np.float32)
    single = made(spark, x).selectExpr("vec_id", "CAST(embedding AS ARRAY<FLOAT>) AS embedding", "label")
    for query in (vector_dedup.near_vectors, vector_search.nearest_vectors):
        assert sorted(query(single).collect()) == sorted(query(made(spark, x)).collect())


def test_products_beyond_a_double(spark):
    x = np.random.default_rng(9).standard_normal((60, 6))
    x = np.abs(x) * 1e200
    rows = vector_search.nearest_vectors(made(spark, x), every=1).collect()
    want = brute(np.arange(60), x * 1e-200, 1, 20)
    assert {(r["query_id"], r["rank"]): r["vec_id"] for r in rows} == {(q, n): i for q, found in want.items() for n, (i, _) in enumerate(found, 1)}
    assert all(r["score"] == float("inf") for r in rows)
    tiny = vector_search.nearest_vectors(made(spark, x * 1e-200 * 1e-250), every=1).collect()
    assert {(r["query_id"], r["rank"]): r["vec_id"] for r in tiny} == {(r["query_id"], r["rank"]): r["vec_id"] for r in rows}


@pytest.mark.parametrize("n", [600, 2400, 6000])
def test_links_at_the_threshold_are_found(n):
    """The share of pairs at exactly the least cosine that the index reaches, whatever the number of cells."""
    rng = np.random.default_rng(n)
    centres = vectors.unit(rng.standard_normal((40, 24)))
    x = vectors.unit(centres[rng.integers(0, 40, n)] + 0.15 * rng.standard_normal((n, 24)))
    index = vector_dedup.fit(x, 40 * n)
    side = rng.standard_normal(x.shape)
    side = vectors.unit(side - (side * x).sum(1, keepdims=True) * x)
    y = 0.95 * x + (1 - 0.95**2) ** 0.5 * side
    ours, theirs, a, b = index.visited(x), index.visited(y), index.cells(x), index.cells(y)
    assert ((ours == b[:, None]).any(1) | (theirs == a[:, None]).any(1)).mean() >= 0.99
    assert index.visits < 0.5 * len(index.left) * len(index.right)


def test_many_lists_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "ONE_LEVEL", 4)
    monkeypatch.setattr(vector_search, "LIST_ROWS", 20)
    monkeypatch.setattr(vector_search, "CENTRE_ROWS", 16)
    x = np.random.default_rng(12).standard_normal((1200, 10))
    want, got = brute(np.arange(1200), x, 20, 20), {}
    for r in vector_search.nearest_vectors(made(spark, x)).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sum(len({i for i, _ in want[q]} & got[q]) for q in want) >= 0.9 * 20 * len(want)

"""Near-duplicates against all pairs, and the parts of the sketch."""

import random

import numpy as np
import pytest

from tests.llm.shared import ODD_TEXTS, documents, near_groups, shingles
from tickloom.llm import near_dup
from tickloom.llm.components import components
from tickloom.llm.queries import QUERIES


def words(rng, n, pool=4000):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def near_copies(seed):
    """Copies of a few texts with more and more changes, so that some chain and some stand alone."""
    rng, out = random.Random(seed), []
    for _ in range(4):
        base = words(rng, rng.randrange(40, 200))
        for copy in range(12):
            text = list(base)
            for _ in range(rng.randrange(0, copy + 1)):
                text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
            out.append(" ".join(text))
    return out


def test_whole_table_against_all_pairs(spark, sf_dir):
    small = sf_dir.replace("sf0.01", "sf0.001")
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = near_groups(docs, 3, 85)
    rows = QUERIES["op4_minhash_near_dedup"](spark, small).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(shingles(t, 3)) for i, t in docs}


@pytest.mark.parametrize("how", [near_dup.Sketching(3, 85), near_dup.Sketching()])
def test_chains_and_copies(spark, how):
    texts = near_copies(3) + ["one two", "One  TWO", "one two three", "", None]
    docs = list(enumerate(texts))
    df = documents(spark, [(i, t, "s") for i, t in docs])
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(df, how).collect()}
    assert got == near_groups(docs, how.words, how.percent)


def test_odd_rows(spark):
    rows = [(k, t, None) for k, t in enumerate(ODD_TEXTS)] + [(None, "a b c d e f", "s"), (5, "a b c d e f", "s")]
    got = near_dup.near_duplicates(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[6]["component_id"] == 4 and not by[6]["kept"]  # the same word
    assert by[0]["kept"] and by[0]["n_shingles"] == 0
    nameless = next(r for r in got if r["doc_id"] is None)
    assert nameless["kept"] and nameless["component_id"] is None
    left = near_dup.without_near_duplicates(documents(spark, rows))
    assert left.columns == documents(spark, []).columns
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == [0, 1, 2, 3, 4, 5, 5, 7, 8, 9]


def test_empty_table(spark):
    assert near_dup.near_duplicates(documents(spark, [])).collect() == []
    assert near_dup.without_near_duplicates(documents(spark, [])).collect() == []


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    sketch = near_dup.registers(600)
    a, b, c = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (900, 300, 300))
    x, y = np.concatenate([a, b]), np.concatenate([a, c])
    r = [np.frombuffer(sketch(s), np.uint8) for s in (a, b, x, y)]
    assert (np.maximum(r[0], r[1]) == r[2]).all()
    got = near_dup.estimate(r[2][None], r[3][None], np.array([1200.0]), np.array([1200.0]))[0]
    assert abs(got - 0.6) < 0.08


def test_prefix_pairs_hold_all_links(spark):
    docs = [(i, t) for i, t in enumerate(near_copies(5))]
    how = near_dup.Sketching(3, 85)
    make = near_dup.shingle_sets(3)
    sets = spark.createDataFrame([(i, bytearray(make(t).tobytes())) for i, t in docs], "node long, shingles binary")
    apart = spark.createDataFrame([(i, i) for i, _ in docs], "node long, comp long")
    pairs = {(r["a"], r["b"]) for r in near_dup._prefix_pairs(apart, sets, how).collect()}
    plain = {i: shingles(t, 3) for i, t in docs}
    links = {
        (i, j)
        for i in plain
        for j in plain
        if i > j and plain[i] != plain[j] and 100 * len(plain[i] & plain[j]) >= 85 * len(plain[i] | plain[j])
    }
    assert links and links <= pairs and len(pairs) < len(docs) ** 2 / 6


def test_components_of_random_links(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)]
    group = {x: x for pair in links for x in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(group[a], group[b])
            if group[a] != low or group[b] != low:
                group[a] = group[b] = low
                changed = True
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    named = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: group[x] for x in named}

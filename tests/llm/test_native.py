"""Mixing and line dedup on odd rows; the whole tables are compared with SQL elsewhere."""

import math
from collections import Counter

import pytest

from tests.llm.shared import ODD_TEXTS, documents, without_repeats
from tickloom.llm import line_dedup, mixing


def plans(df):
    return df._jdf.queryExecution().toString()


def test_no_python_in_the_plans(spark):
    df = documents(spark, [(1, "a", "s")])
    for out in (mixing.mix(df), line_dedup.dedup_lines(df)):
        assert not any(word in plans(out) for word in ("Python", "Arrow", "Pandas"))


def test_mix_keeps_columns_and_is_the_same_each_time(spark):
    df = documents(spark, [(k, f"text {k}", "ab"[k % 2]) for k in range(400)])
    first, second = (mixing.mix(df, epochs=2.0, copy_col="copy_no") for _ in range(2))
    assert first.columns == [*df.columns, "copy_no"]
    rows = [tuple(r) for r in first.collect()]
    assert sorted(rows, key=str) == sorted((tuple(r) for r in second.collect()), key=str)
    assert abs(len(rows) - 800) < 5 * math.sqrt(800)


def test_rates_reach_the_weights(spark):
    df = documents(spark, [(k, "t", "a" if k < 900 else "b") for k in range(1000)])
    rates = {r["source"]: r["rate"] for r in mixing.source_rates(df, {"a": 1.0, "b": 1.0}, epochs=3).collect()}
    assert rates == {"a": pytest.approx(1500 / 900), "b": pytest.approx(15.0)}
    counts = Counter(r["source"] for r in mixing.mix(df, {"a": 1.0, "b": 1.0}, epochs=3).collect())
    assert all(abs(counts[s] - 1500) < 5 * math.sqrt(1500) for s in "ab")


def test_large_mean_is_a_sum_of_draws(spark):
    df = documents(spark, [(1, "t", "rare")] + [(k, "t", "common") for k in range(2, 400)])
    rows = mixing.mix(df, {"rare": 3.0, "common": 1.0}).collect()
    assert abs(sum(r["source"] == "rare" for r in rows) - 300) < 5 * math.sqrt(300)


def test_mix_null_source_ids_and_texts(spark):
    rows = [(None, t, None) for t in ODD_TEXTS] * 20 + [(7, "same", "s")] * 5
    out = mixing.mix(documents(spark, rows), {None: 1.0, "s": 1.0}, epochs=4)
    assert {r["source"] for r in out.collect()} <= {None, "s"}
    same = Counter(r["doc_id"] for r in mixing.mix(documents(spark, rows), copy_col="c").collect() if r["doc_id"] == 7)
    assert same[7] % 5 == 0  # rows with one id get the same number of copies
    assert mixing.mix(documents(spark, rows), {"s": 0.0}).collect() == []


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert mixing.mix(empty).collect() == [] and line_dedup.without_repeats(empty).collect() == []


def test_lines_against_a_direct_version(spark):
    block = "l1\nl2\nl3\nl4"
    texts = [
        f"head\n{block}\ntail",
        f"other\n{block}\nend\nmore",
        block,
        "a\nb\na\nb\na\nb\na\nb",
        "\n\n\n\n\n\n",
        " \n\n \nx\ny\nz",
        "x\ny\nz",
        *ODD_TEXTS,
    ]
    docs = list(enumerate(texts))
    df = documents(spark, [(i, t, None) for i, t in docs])
    out = line_dedup.dedup_lines(df, counts=("n_lines", "n_removed"))
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == without_repeats(docs)
    assert out.columns == [*df.columns, "n_lines", "n_removed"]
    left = {r["doc_id"] for r in line_dedup.without_repeats(df).collect()}
    assert left == {i for i, t in docs if not (got[i] != t and not got[i].strip(" "))}


def test_repeated_rows_are_treated_alike(spark):
    text = "a\nb\nc"
    df = documents(spark, [(1, text, "s"), (1, text, "s"), (None, text, "s"), (2, text, "s")])
    got = Counter((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(df).collect())
    assert got == {(None, text): 1, (1, ""): 2, (2, ""): 1}


def test_many_lines_in_one_text(spark):
    long = "\n".join(f"line {k % 5000}" for k in range(20_000))
    got = line_dedup.dedup_lines(documents(spark, [(1, long, "s")])).first()["text"]
    assert got == without_repeats([(1, long)])[1]

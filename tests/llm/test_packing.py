"""Packing: planning, ids and places, against direct versions."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import packing
from tickloom.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 9), max_size=20))
@settings(max_examples=60, deadline=None)
def test_plan_uses_each_piece_once(counts):
    seen = Counter()
    for times, content in packing.plan_bins(counts, 64):
        assert sum(length * each for length, each in content) <= 64
        for length, each in content:
            seen[length] += times * each
    assert seen == Counter(counts)


@given(st.integers(0, 30), st.dictionaries(st.integers(1, 30), st.integers(1, 3), max_size=6))
@settings(max_examples=60, deadline=None)
def test_fullest_is_the_largest_sum(room, available):
    sums = {0}
    for length, n in available.items():
        sums = {s + length * k for s in sums for k in range(n + 1)}
    chosen = packing.fullest(room, available)
    assert sum(k * v for k, v in chosen.items()) == max(s for s in sums if s <= room)
    assert all(chosen[k] <= available[k] for k in chosen)


@given(st.lists(st.text(alphabet="aB'sS \t\n é́Σ漢\U0001f6000<|>.!", max_size=30), max_size=5))
@settings(max_examples=60, deadline=None)
def test_word_ids_are_those_of_the_tokenizer(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(packing.word_ids(PATH)(texts)) == want


def test_word_ids_when_few_words_are_remembered(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 40)
    monkeypatch.setattr(packing, "KEPT_WORDS", 10)
    packing._words.cache_clear()
    tokenizer = Tokenizer.from_file(PATH)
    texts = [" ".join(f"word{k * 7 % 91}, it's {k}" for k in range(j, j + 30)) for j in range(0, 400, 2)]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(packing.word_ids(PATH)(texts)) == want
    packing._words.cache_clear()


def check(rows, docs, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    want = Counter()
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want[doc_id, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for content in bins.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


def test_packs_the_whole_table(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op7_best_fit_packing"](spark, sf_dir).collect()
    least = math.ceil(sum(r["length"] for r in rows) / packing.CAPACITY)
    assert check(rows, docs, packing.CAPACITY) <= least + 3


@pytest.mark.parametrize("capacity", [1, 7, 16])
def test_odd_rows(spark, capacity):
    docs = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x"), (None, None), (4, "long words here " * 40)]
    df = spark.createDataFrame([(*d, 9, 9) for d in docs], "doc_id long, text string, length int, rank int")
    check(packing.pack_documents(df, PATH, capacity).collect(), docs, capacity)


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


ADDED = ["see <|endoftext|> here", "<|startoftext|>it<|endoftext|>'s", "no <|EndOfText|> and <|endoftext|", "a b c"]


def test_added_tokens_have_the_ids_of_the_unchanged_tokenizer(spark):
    tokenizer = Tokenizer.from_file(PATH)
    ids = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4") for t in ADDED]
    assert list(packing.word_ids(PATH)(ADDED)) == [x.tobytes() for x in ids]
    docs = spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string")
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packing.pack_documents(docs, PATH).collect()}
    assert got == {k: (len(x) + 1, zlib.crc32(np.append(x, 0).astype("<u4").tobytes())) for k, x in enumerate(ids)}

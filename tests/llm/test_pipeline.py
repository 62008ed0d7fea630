"""The pipeline against a direct version of its stages."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.shared import documents, near_groups, without_repeats
from tickloom.llm import line_dedup, toxicity
from tickloom.llm.common import table


def mixed(docs):
    """{doc_id: copies} for (doc_id, text, source), by summing Poisson probabilities one by one."""
    n = Counter(s for _, _, s in docs)
    total = sum(math.sqrt(v) for v in n.values())
    out = {}
    for i, _, s in docs:
        rate = len(docs) / total * math.sqrt(n[s]) / n[s]
        parts = max(1, math.ceil(rate / 64))
        out[i] = 0
        for part in range(1, parts + 1):
            u = int(hashlib.md5(f"mix:{i}:{part}".encode()).hexdigest()[:13], 16) / 2**52
            k, p = 0, math.exp(-rate / parts)
            below = p
            while below <= u:
                k += 1
                p *= rate / parts / k
                below += p
            out[i] += k
    return out


def test_stages_against_a_direct_version(spark, sf_dir):
    small = sf_dir.replace("sf0.01", "sf0.001")
    docs = [(r["doc_id"], r["text"], r["source"]) for r in table(spark, small, "documents").collect()]
    model = toxicity.fit(table(spark, small, "documents"), table(spark, small, "labels"))
    match = toxicity.matcher(model)
    docs = [d for d in docs if match(d[1]).odds < 0]
    left = without_repeats([d[:2] for d in docs])
    docs = [(i, left[i], s) for i, t, s in docs if left[i] == t or left[i].strip(" \t\n\x0b\f\r")]
    group = near_groups([d[:2] for d in docs], 5, 80)
    docs = [d for d in docs if group[d[0]] == d[0]]
    copies = mixed(docs)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, text, _ in docs:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += copies[i]
    rows = corpus_pipeline.run(spark, small).collect()
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert got == +want
    ends = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 2048


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    small = sf_dir.replace("sf0.01", "sf0.001")
    docs = documents(spark, [(k, f"line {k}\nsecond {k}\nthird {k}", "s") for k in range(20)] + [(None, None, None), (20, "", "s")])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns and out.schema == docs.schema, name
        assert stage(spark, docs.limit(0), small).collect() == [], name


def test_texts_left_with_white_space_only_go(spark):
    passage = "first\nsecond\nthird"
    docs = documents(spark, [(1, passage, "s"), (2, f"{passage}\n\t", "s"), (3, f"{passage}\nmore", "s"), (4, "\t", "s")])
    assert {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(docs).collect()} == {1: passage, 3: "more", 4: "\t"}


def test_stages_and_query():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "minhash_near_dedup", "mix_sources", "best_fit_packing"]
    assert corpus_pipeline.ORACLE_SQL is None

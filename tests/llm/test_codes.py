"""Byte-pair encoding, vector codes and the source audit against direct versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.shared import ODD_TEXTS, documents
from tickloom.llm import bpe, source_audit, vector_codes

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [*ODD_TEXTS, "see <|endoftext|> here<|endoftext|>", "a" * 3000, "don't  stop\n\n now\t!", "é‍ \x1c\x85\xa0x", "1234567 +-=_ ###"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_codec_equals_the_library(spark, library):
    docs = documents(spark, [(i if i % 7 else None, t, "s") for i, t in enumerate(TEXTS)])
    rows = bpe.round_trip(docs, PATH).collect()
    assert len(rows) == len(TEXTS) and rows[0].asDict().keys() == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    want = Counter()
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), decoded.encode())]
        want[(i if i % 7 else None, len(ids), *digests)] += 1
    assert Counter(map(tuple, rows)) == want


def test_encoded_lists_decode_to_the_texts(spark):
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(TEXTS)])
    back = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    some = spark.createDataFrame([(1, [50256, 99_999, 64]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in bpe.decode(some, PATH).collect()} == {1: "<|endoftext|>a", 2: "", 3: ""}


def test_no_documents(spark):
    assert bpe.round_trip(documents(spark, []), PATH).collect() == []
    assert source_audit.source_divergence(documents(spark, [])).collect() == []


def test_words_of_any_bytes(library):
    own = bpe.codec(PATH)
    rng = random.Random(3)
    labels = [own.label[i] for i in sorted(own.automaton.born)]
    for _ in range(3000):
        text = b"".join(rng.choice(labels) for _ in range(rng.randrange(1, 6))).decode("utf-8", "ignore")
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def merged(word, ranks):
    """Merges the pair of the lowest rank, the first such place first, until none is left."""
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(word, word[1:])) if p in ranks]
        if not found:
            return word
        _, i = min(found)
        word = word[:i] + [word[i] + word[i + 1]] + word[i + 2 :]


@pytest.mark.parametrize("seed", range(8))
def test_automaton_has_the_path_of_the_merges_and_no_other(seed):
    rng = random.Random(seed)
    tokens, ranks = ["a", "b", "c"], {}
    while len(ranks) < 14:
        pair = (rng.choice(tokens), rng.choice(tokens))
        if pair[0] + pair[1] not in tokens:
            ranks[pair] = len(ranks)
            tokens.append(pair[0] + pair[1])
    number = {t: i for i, t in enumerate(tokens)}
    automaton = bpe.MergeAutomaton([0, 1, 2], [(number[a], number[b], number[a + b]) for a, b in ranks])
    for size in range(1, 8):
        for k in range(3**size):
            text = "".join("abc"[k // 3**i % 3] for i in range(size))
            assert accepted(text, automaton, number) == [merged(list(text), ranks)]


def accepted(text, automaton, number):
    done, open_ = [], [([], 0, bpe.START)]
    while open_:
        path, at, state = open_.pop()
        if at == len(text):
            done.append(path)
        for end in range(at + 1, len(text) + 1):
            token = number.get(text[at:end])
            if token is not None and automaton.follows(state, token):
                open_.append(([*path, text[at:end]], end, token))
    return done


def test_merges_out_of_order_are_refused():
    for merges in ([(0, 1, 2), (1, 0, 2)], [(0, 3, 2), (0, 1, 3)]):
        with pytest.raises(ValueError):
            bpe.MergeAutomaton([0, 1], merges)


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, label, b"x", 1.5) for i, v, label in rows], "vec_id long, embedding array<double>, label int, near binary, error double"
    )


def coded(rows):
    """{(vec_id, vector): (code, error, digest)} of rows of one length, by the definition."""
    x = [[math.floor(256 * c) if abs(c) < 2**53 else 256 * int(c) for c in v] for _, v, _ in rows]
    first = {}
    for (i, _, _), v in zip(rows, x):
        if i is not None:
            first[i] = min(first.get(i, v), v)
    cuts = [(p * len(x[0]) // 16, (p + 1) * len(x[0]) // 16) for p in range(16)]
    books = [[first[i][lo:hi] for i in sorted(first)[:64]] for lo, hi in cuts]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(2):
        for (lo, hi), book in zip(cuts, books):
            groups = {}
            for v in x:
                groups.setdefault(nearest(v[lo:hi], book)[1], []).append(v[lo:hi])
            for e, parts in groups.items():
                book[e] = [sum(c) // len(parts) for c in zip(*parts)]
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    out = []
    for v in x:
        found = [nearest(v[lo:hi], book) for (lo, hi), book in zip(cuts, books)]
        out.append(("".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), digest))
    return out


def expected(*collections):
    rows = [(r, c) for rows in collections for r, c in zip(rows, coded(rows))]
    by_label = Counter()
    for (_, _, label), (_, error, _) in rows:
        by_label[label] += error
    return Counter((i, code, error, by_label[label], digest) for (i, _, label), (code, error, digest) in rows)


def made(n, width, seed, start=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((20, width))
    x = centres[rng.integers(0, 20, n)] + 0.1 * rng.standard_normal((n, width))
    return [(start + i, v.tolist(), [0, 1, None][i % 3]) for i, v in enumerate(x)]


def test_codes_equal_the_definition(spark, monkeypatch):
    long, short = made(400, 32, 1), made(90, 20, 2, 1000)
    long += [(5, long[9][1], 0), (5, [0.0] * 32, None), (None, long[3][1], 1), (700, [0.5] * 32, 2)] + [(800 + i, long[7][1], 2) for i in range(40)]
    odd = [(900, None, 0), (901, [1.0, None] * 16, 0), (902, [float("nan")] * 32, 0), (903, [float("inf")] * 32, 0)]
    want = expected(long, short)
    df = vectors(spark, long + short + odd).repartition(5)
    assert Counter(map(tuple, vector_codes.vector_codes(df).collect())) == want
    for closest in (2, 64):  # how many bounds are kept changes no result
        monkeypatch.setattr(vector_codes, "CLOSEST", closest)
        assert Counter(map(tuple, vector_codes.vector_codes(df).collect())) == want


def test_few_rows_large_numbers_and_none(spark):
    rows = [(i, [1e12 + i + j for j in range(16)], 0) for i in range(70)] + [(None, [1e12] * 16, None)]
    assert Counter(map(tuple, vector_codes.vector_codes(vectors(spark, rows)).collect())) == expected(rows)
    far = [(i, [1e12 * i] * 16, 0) for i in range(66)]
    assert {r["error"] for r in vector_codes.vector_codes(vectors(spark, far)).collect()} == {0, 2**63 - 1}
    some = [(1, [0.1] * 16, None), (1, [0.1] * 16, None)]
    assert Counter(map(tuple, vector_codes.vector_codes(vectors(spark, some)).collect())) == expected(some)
    nobody = vector_codes.vector_codes(vectors(spark, [(None, [0.1] * 16, 1)])).collect()
    assert [tuple(r) for r in nobody] == [(None, None, None, None, None)]
    assert vector_codes.vector_codes(vectors(spark, [])).collect() == []
    empty = vector_codes.vector_codes(vectors(spark, [(1, [], 1), (2, [], 1)])).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in empty) == [(1, "00" * 16, 0), (2, "00" * 16, 0)]


def test_bounds_are_never_too_high():
    x = np.random.default_rng(0).random(1000) * 10.0 ** np.random.default_rng(1).integers(-6, 8, 1000)
    assert (vector_codes._below(x).astype(float) <= x).all() and np.isinf(vector_codes._below(np.array([np.inf]))).all()


def audit(docs, ranks=200):
    """Rows of the audit over (text, lang, source), by the definition."""
    words, seen, groups = {}, {}, {}
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        words.setdefault((lang, source), Counter()).update(terms)
        seen.setdefault(lang, Counter()).update(set(terms))
        groups.setdefault(lang, set()).add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= 3]
        counts = {s: {t: words[lang, s][t] for t in kept} for s in sources}
        whole = {t: sum(counts[s][t] for s in sources) for t in kept}

        def shares(count):
            total = sum(count.values()) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept}

        p, q = {s: shares(counts[s]) for s in sources}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, rows, most in (("pair", pairs, None), ("term", terms, ranks)):
                ordered = sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:most]
                out |= {(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ordered, 1)}
    return out


def texts():
    rng = random.Random(5)
    vocabulary = ["Alpha", "beta", "Gamma9delta", "été", "ÉTÉ", "漢字", "x", "zz", "don't", "\U0001f600"] + [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    docs = []
    for i in range(240):
        lang = ["en", "fr", None, "de"][i % 4]
        source = f"s{rng.randrange(4)}" if i % 9 else None
        docs.append((" ".join(rng.choices(vocabulary, k=rng.randrange(0, 60))), lang, source))
    return docs + [(t, "en", "odd") for t in ODD_TEXTS] + [(None, "xx", "only"), ("one two", "yy", "a"), ("three", "yy", "b")] + [("hot hot HOT", "de", "s1")] * 50


def test_audit_equals_the_definition(spark, monkeypatch):
    docs = texts()
    df = spark.createDataFrame([(t, l, s, 1, "x") for t, l, s in docs], "text string, lang string, source string, n long, term string").repartition(6)
    columns = ("lang", "source", "part", "item", "value", "rank")
    assert set(map(tuple, source_audit.source_divergence(df).select(*columns).collect())) == audit(docs)
    monkeypatch.setattr(source_audit, "HELD_WORDS", 20)  # tasks pass their counts on often
    monkeypatch.setattr(source_audit, "TABLE_CELLS", 8)
    got = source_audit.source_divergence(df, ranks=7).select(*columns).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == audit(docs, 7)


def test_shares_of_large_counts_are_exact():
    counts, total = np.array([0, 7, 10**14, 8 * 10**15]), np.array([3, 9 * 10**15, 9 * 10**15, 9 * 10**15])
    assert source_audit._long_share(counts, total).tolist() == [1 + 10**9 * (c + 1) // t for c, t in zip(counts.tolist(), total.tolist())]

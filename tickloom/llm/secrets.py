"""Secret scans: fixed forms, and random strings found by how badly a tokenizer compresses them."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame

from tickloom.llm.common import per_text
from tickloom.llm.token_counts import PATTERN, read_ranks

# The base forms, in the order in which they are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

# Candidates of the token test, and what is known not to be a secret.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
DIGEST = re.compile(r"[0-9A-Fa-f]+")
DIGEST_LENGTHS = frozenset({32, 40, 48, 56, 64, 96, 128})
PARTS = re.compile(r"[^+/_=-]+")
CAMEL = re.compile(r"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,5}(?![a-z]))+[0-9]{0,4}")
# Parts of at least so many characters are words that end a run of parts; a key rarely has such a part.
LEAST_WORD, LEAST_PART = 4, 16
SHORT = re.compile(r"[a-z]{2,3}|[0-9]{2,3}")
# Letters of one case longer than natural words of the tables (24), and the distinct letters that such a key has.
LONG_LETTERS = re.compile(r"[A-Za-z][a-z]{24,}|[A-Z]{25,}")
LEAST_DISTINCT = 10
WHOLE_UUID = re.compile(rf"(?<![0-9A-Za-z]){UUID.pattern}(?![0-9A-Za-z])")
BLOCK = 4096


@dataclass(frozen=True)
class TokenTest:
    """Random strings have fewer characters per token than `most`; natural words have more."""

    ranks_path: str
    most: float = 2.1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms: leftmost matches of each kind that do not overlap."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    # Runs are maximal, so asking for the least length at once finds the same ones.
    found += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found)


_LONG_HEX = re.compile(f"{HEX.pattern[:-1]}{{{LEAST_HEX},}}")


def is_long_letters(part: str) -> bool:
    """Whether it is letters of one case, too long to be taken for a word without the token test."""
    return bool(LONG_LETTERS.fullmatch(part)) and len(set(part)) >= LEAST_DISTINCT


def is_plain(part: str) -> bool:
    """Whether a part is words, letters of one case or digits."""
    if is_long_letters(part):
        return False
    return bool(CAMEL.fullmatch(part) or part.isalpha() and (part.islower() or part.isupper()) or part.isdigit())


def is_named(candidate: str) -> bool:
    """Whether it is a digest, a UUID, a number, or an identifier made of words and short numbers."""
    if UUID.fullmatch(candidate) or (len(candidate) in DIGEST_LENGTHS and DIGEST.fullmatch(candidate)):
        return True
    if is_long_letters(candidate):
        return False
    has = [any(test(c) for c in candidate) for test in (str.isdigit, str.islower, str.isupper)]
    if sum(has) < 2:
        return True
    parts = PARTS.findall(candidate)
    if not has[0] and all(p.istitle() or p.islower() or p.isupper() for p in parts):
        return True
    plain = [is_plain(p) for p in parts]
    return sum(plain) >= max(1, len(parts) - 1) and all(ok or len(p) <= 6 for p, ok in zip(parts, plain))


def inner_runs(value: str) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """What lies between the words, numbers, digests and UUIDs of a path or joined name.

    (start, end, its parts of LEAST_PART or more characters) of each longest run of parts, less short
    words and numbers at its ends. A key may have separators inside, so a run is one candidate and its
    parts are others.
    """
    uuids = [m.span() for m in WHOLE_UUID.finditer(value)] if value.count("-") >= 4 else []
    runs, run = [], []
    for m in PARTS.finditer(value):
        p = m.group()
        named = len(p) >= LEAST_WORD and is_plain(p) or len(p) in DIGEST_LENGTHS and DIGEST.fullmatch(p)
        if named or any(s <= m.start() < e for s, e in uuids):
            runs.append(run)
            run = []
        else:
            run.append((*m.span(), bool(SHORT.fullmatch(p))))
    found = []
    for run in [*runs, run]:
        odd = [k for k, (*_, short) in enumerate(run) if not short]
        if odd:
            run = run[odd[0] : odd[-1] + 1]
            found.append((run[0][0], run[-1][1], [(s, e) for s, e, _ in run if e - s >= LEAST_PART]))
    if found and found[-1][1] == len(value.rstrip("=")):  # padding belongs to the key
        found[-1] = (found[-1][0], len(value), found[-1][2])
    return found


def scanner(test: TokenTest):
    """A function from a text to all (start, kind, end), sorted."""
    encoding = []

    def tokens(value: str) -> int:
        if not encoding:
            import tiktoken

            ranks = {piece: rank for rank, piece in enumerate(read_ranks(test.ranks_path))}
            encoding.append(tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}))
        return sum(len(encoding[0].encode_ordinary(value[k : k + BLOCK])) for k in range(0, len(value), BLOCK))

    def run(text: str) -> list[tuple[int, int, int]]:
        found = base_spans(text)
        # Starts of the fixed forms in order, and the farthest end up to each.
        covered = sorted((s, e) for s, _, e in found)
        starts, reach = [s for s, _ in covered], list(accumulate((e for _, e in covered), max))

        def is_random(start: int, end: int) -> bool:
            value = text[start:end]
            before = bisect_left(starts, end)
            if len(value) < LEAST_PART or before and reach[before - 1] > start or is_named(value):
                return False
            return len(value) / tokens(value) < test.most

        for m in CANDIDATE.finditer(text):
            at = m.start()
            runs = inner_runs(m.group())
            if is_random(at, m.end()):
                # Less the words at its ends, where the rest is random too.
                start, end = at, m.end()
                if runs and runs[0][0] - 1 > LEAST_WORD:
                    start = at + runs[0][0]
                if runs and len(m.group()) - runs[-1][1] > LEAST_WORD:
                    end = at + runs[-1][1]
                found.append((start, 3, end) if is_random(start, end) else (at, 3, m.end()))
                continue
            for start, end, parts in runs:
                spans = [(start, end)] if is_random(at + start, at + end) else [p for p in parts if is_random(at + p[0], at + p[1])]
                found += [(at + s, 3, at + e) for s, e in spans]
        return sorted(found)

    return run


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def secrets(docs: DataFrame, test: TokenTest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: counts by kind, a digest of the fixed forms' spans, and all spans.

    Spans are code points, end exclusive. The token test looks at long runs of letters, digits and
    `+/_=-` that no fixed form touches: known digests, UUIDs, numbers and identifiers are excluded,
    and what has few characters per token is random. A run that is not random as a whole, or that a
    fixed form touches, is looked at again without its words (see `inner_runs`), so that a key in a path
    or joined name is found; the span is then that of the key. Digits alone are never reported, nor are
    letters of one case up to 24 characters or with fewer than LEAST_DISTINCT letters: words and numbers
    as long also have few characters per token. A null text is empty; repeated and null
    ids give a row each.
    """

    def make():
        scan = scanner(test)

        def run(texts: list[str]) -> dict[str, list]:
            found = [scan(t) for t in texts]
            out = {f"n_{k}": [sum(s[1] == i for s in f) for f in found] for i, k in enumerate(KINDS)}
            base = [_joined([s for s in f if s[1] < 3]) for f in found]
            out["base_sha256"] = [hashlib.sha256(b.encode()).hexdigest() for b in base]
            out["spans"] = [_joined(f) for f in found]
            return out

        return run

    fields = ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return per_text(docs, make, fields, id_col, text_col)

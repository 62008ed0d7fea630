"""Byte-pair encoding by a tokenization automaton, and decoding by its arc labels."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Sequence
from functools import cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tickloom.llm.common import per_text, quoted
from tickloom.llm.token_counts import PATTERN

# Words whose ids a worker remembers, and the longest of them, in characters.
CACHED_WORDS, CACHED_LENGTH = 300_000, 64
# Fixed value: the bytes that byte-level vocabularies write as the character of the same number; the
# others follow from 256 on.
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
WORDS = regex.compile(PATTERN)
# Anything but printable ASCII and Latin letters and signs below the combining marks.
UNUSUAL = re.compile("[^\t\n\r -~¡-¬®-įĲ-ʯ]")
START = -1


def byte_characters() -> dict[str, int]:
    """The character by which a byte-level vocabulary writes each byte."""
    others = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + k): b for k, b in enumerate(others)}


class MergeAutomaton:
    """The deterministic automaton that accepts exactly the token sequences that the merges give.

    It starts as one state with an arc for each byte, and each merge (a, b) -> ab is one gadget on what
    the merges before made: the state that `a` leads to is replaced by a copy without the arc `b`, and
    every state with an arc `a` gets an arc `ab`, which leads where `b` led. All arcs of one token lead
    to the same state, so a state is named by its token. A copy shares its arcs with its original: only
    the arcs that a gadget took (`lost`) and the gadget that made a token's arcs (`born`) are kept, and
    an arc is looked up along the copies. All states accept, and each text has one path.

    `alphabet` holds the tokens of single bytes, `merges` (left, right, merged) in order.
    """

    def __init__(self, alphabet: Sequence[int], merges: Sequence[tuple[int, int, int]]):
        self.born = dict.fromkeys(alphabet, 0)
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.lost: dict[tuple[int, int], int] = {}
        self.known: dict[tuple[int, int], bool] = {}
        made = set(alphabet)
        for step, (a, b, merged) in enumerate(merges, 1):
            if merged in made or not {a, b} <= made:
                raise ValueError(f"merge {step} makes a token again, or uses one that no merge before it makes")
            made.add(merged)
            if a not in self.born or b not in self.born or not self._arc(a, b, step):
                continue  # no text leads here, so the merge never applies
            self.born[merged], self.left[merged], self.right[merged] = step, a, b
            self.lost[a, b] = step

    def _arc(self, state: int, token: int, step: float) -> bool:
        """Whether the state of `state` has an arc `token` after that many gadgets."""
        born, lost = self.born, self.lost
        while True:
            gone = lost.get((state, token))
            if gone is not None and gone <= step:
                return False
            if born[token] and born[token] >= born[state]:
                # The gadget gave this arc to states that had one for its left part.
                step, token = born[token], self.left[token]
            elif born[state]:
                # The state is the one of its right part, as it was before the gadget.
                step, state = born[state] - 1, self.right[state]
            else:
                return True

    def follows(self, state: int, token: int) -> bool:
        """Whether `token` is an arc of the state; the start has one for each token that can occur."""
        if state == START or token not in self.born:
            return token in self.born
        found = self.known.get((state, token))
        if found is None:
            found = self._arc(state, token, float("inf"))
            if len(self.known) < 4_000_000:
                self.known[state, token] = found
        return found


class ByteLevelCodec:
    """Encodes and decodes as a byte-level tokenizer file does, by a `MergeAutomaton`.

    Added tokens are split off first, then words by the vocabulary's pattern. Files with other
    normalizers, splitters or options than these are refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        _require_plain(spec)
        of_character = byte_characters()
        vocabulary: dict[str, int] = spec["model"]["vocab"]
        self.label: dict[int, bytes] = {
            number: bytes(of_character[c] for c in text) for text, number in vocabulary.items() if all(c in of_character for c in text)
        }
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        merges = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs]
        single = [vocabulary[c] for c in of_character]
        self.automaton = MergeAutomaton(single, merges)
        self.added: dict[str, int] = {}
        for token in spec["added_tokens"]:
            self.added[token["content"]] = token["id"]
            self.label[token["id"]] = _added_label(token["content"], of_character)
        longest_first = sorted(filter(None, self.added), key=len, reverse=True)
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        # The labels of all arcs as a table: (node, byte) to node, and the token that ends at a node.
        self.step: dict[int, int] = {}
        self.ends: list[int] = [-1]
        for token in self.automaton.born:
            node = 0
            for byte in self.label[token]:
                node = self.step.setdefault(node << 8 | byte, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = token
        self.longest = max(map(len, self.label.values()))
        self.words = _Words(self.path_of)

    def path_of(self, word: bytes) -> list[int]:
        """The tokens of the one path whose labels give the bytes of a word.

        The longest token that is an arc of the state is tried first. Each beginning of a word has one
        path too, so a position from which no path goes on is not entered again, and the work is in
        proportion to the word's length.
        """
        step, ends, follows, label = self.step, self.ends, self.automaton.follows, self.label
        size = len(word)
        ended = bytearray(size)  # positions from which no path goes on
        path: list[int] = []
        untried: list[list[int]] = []
        at = 0
        while at < size:
            if len(untried) == len(path):  # a new position: the tokens that the next bytes spell
                found, node = [], 0
                for byte in word[at : at + self.longest]:
                    node = step.get(node << 8 | byte, -1)
                    if node < 0:
                        break
                    if ends[node] >= 0:
                        found.append(ends[node])
                untried.append(found)
            state, left = path[-1] if path else START, untried[-1]
            while left:
                token = left.pop()
                after = at + len(label[token])
                if (after == size or not ended[after]) and follows(state, token):
                    path.append(token)
                    at = after
                    break
            else:
                ended[at] = 1
                untried.pop()
                at -= len(label[path.pop()])
        return path

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        if self.added_pattern is None or not self.added_pattern.search(text):
            return self._encode_plain(text)
        parts = self.added_pattern.split(text)
        return b"".join(
            self.added[part].to_bytes(4, "little") if k % 2 else self._encode_plain(part) for k, part in enumerate(parts) if part
        )

    def _encode_plain(self, text: str) -> bytes:
        if UNUSUAL.search(text):  # the file's own splitter knows how its library takes such characters
            words = [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        else:
            words = WORDS.findall(text)
        return b"".join(map(self.words.__getitem__, words))

    def decode(self, ids: Sequence[int]) -> str:
        """The labels of the arcs one after the other; ids without one are left out."""
        label = self.label
        return b"".join([label[i] for i in ids if i in label]).decode("utf-8", "replace")


class _Words(dict):
    """The ids of each word as bytes, found once."""

    def __init__(self, path_of: Callable[[bytes], list[int]]):
        super().__init__()
        self.path_of = path_of

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.path_of(word.encode()), "<u4").tobytes()
        if len(self) < CACHED_WORDS and len(word) <= CACHED_LENGTH:
            self[word] = ids
        return ids


def _require_plain(spec: dict) -> None:
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and spec["normalizer"] is None
        and split.get("type") == "ByteLevel"
        and not split.get("add_prefix_space")
        and split.get("use_regex", True)
        and (spec["decoder"] or {}).get("type") == "ByteLevel"
        and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        and set(byte_characters()) <= set(model["vocab"])
    )
    if not plain:
        raise ValueError("not a plain byte-level BPE tokenizer")


def _added_label(content: str, of_character: dict[str, int]) -> bytes:
    return bytes(of_character[c] for c in content) if all(c in of_character for c in content) else content.encode()


@cache
def codec(path: str) -> ByteLevelCodec:
    """Compiled once per worker process."""
    return ByteLevelCodec(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every whole text. A null or empty text has none; rows with null or
    repeated ids are encoded like any other."""

    def make():
        own = codec(path)
        return lambda texts: {"ids": [np.frombuffer(own.encode(t), "<u4") for t in texts]}

    return per_text(docs, make, "ids array<int>", id_col, text_col)


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the text of every list of ids; null ids, and ids the vocabulary lacks, give nothing."""
    lists = tokens.select(quoted(id_col), quoted(ids_col).alias("text"))

    def make():
        own = codec(path)
        return lambda batch: {"text": [own.decode(ids or []) for ids in batch]}

    return per_text(lists, make, "text string", id_col, cast=False)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and decoded again.

    Digests are of the ids as little-endian 32-bit integers and of the decoded text in UTF-8, in
    lower-case hex. A null text counts as empty; each row is encoded, whatever its id. One pass, no shuffle.
    """

    def make():
        own = codec(path)

        def run(texts: list[str]) -> dict[str, list]:
            found: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in texts:
                raw = own.encode(text)
                decoded = own.decode(np.frombuffer(raw, "<u4").tolist())
                found["n_tokens"].append(len(raw) // 4)
                found["ids_sha256"].append(hashlib.sha256(raw).hexdigest())
                found["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            return found

        return run

    return per_text(docs, make, "n_tokens long, ids_sha256 string, decoded_sha256 string", id_col, text_col)

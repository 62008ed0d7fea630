"""Token counts by a longest-match automaton that never builds a piece."""

from __future__ import annotations

import base64
from collections import deque

import regex
from pyspark.sql import DataFrame

from tickloom.llm.common import per_text

# Splits text into words before pieces are matched (the pattern of the rank files' vocabularies).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_WORDS = 300_000


def read_ranks(path: str) -> list[bytes]:
    """The pieces of a rank file: lines of base64 and rank."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class LongestMatch:
    """Counts the pieces of a greedy longest-match split in one pass over a word's bytes.

    The vocabulary is a trie. Where no child fits the next byte, the longest pieces of what has been
    read are taken off: a node's failure link leads to the node of the rest, and `pops` says how many
    pieces that took. Both are made once, for nodes in order of depth.
    """

    def __init__(self, vocabulary: list[bytes]):
        self.child: dict[int, int] = {}
        ends = [False]
        for piece in vocabulary:
            node = 0
            for byte in piece:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(ends)
                    ends.append(False)
                node = self.child[key]
            ends[node] = bool(piece)
        below: dict[int, list[tuple[int, int]]] = {}
        for key, node in self.child.items():
            below.setdefault(key >> 8, []).append((key & 255, node))
        self.fail, self.pops = [-1] * len(ends), [0] * len(ends)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for byte, node in below.get(parent, ()):
                queue.append(node)
                if ends[node]:
                    self.fail[node], self.pops[node] = 0, 1
                    continue
                back, popped = self.fail[parent], self.pops[parent]
                while back >= 0 and back << 8 | byte not in self.child:
                    popped += self.pops[back]
                    back = self.fail[back]
                if back >= 0:
                    self.fail[node], self.pops[node] = self.child[back << 8 | byte], popped

    def count(self, word: bytes) -> int:
        """The number of pieces; 1 for a word that the vocabulary cannot split to its end."""
        child, fail, pops = self.child, self.fail, self.pops
        node = total = 0
        for byte in word:
            while node << 8 | byte not in child:
                if fail[node] < 0:
                    return 1
                total += pops[node]
                node = fail[node]
            node = child[node << 8 | byte]
        while node:
            if fail[node] < 0:
                return 1
            total += pops[node]
            node = fail[node]
        return total


def token_counts(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_tokens) per row of `docs`: words of PATTERN, and greedy pieces of them.

    Null and empty texts have no words. Each row gives one row, repeated ids included. The counts of
    frequent words are remembered in each task; a text is never shuffled.
    """

    def make():
        split, automaton = regex.compile(PATTERN), LongestMatch(read_ranks(ranks_path))
        known: dict[str, int] = {}

        def count(text: str) -> tuple[int, int]:
            words = split.findall(text)
            for word in set(words).difference(known):
                known[word] = automaton.count(word.encode("utf-8", "surrogatepass"))
            total = sum(map(known.__getitem__, words))
            if len(known) > CACHED_WORDS:
                known.clear()
            return len(words), total

        def run(texts: list[str]) -> dict[str, list]:
            found = [count(t) for t in texts]
            return {"n_words": [w for w, _ in found], "n_tokens": [n for _, n in found]}

        return run

    return per_text(docs, make, "n_words long, n_tokens long", id_col, text_col)

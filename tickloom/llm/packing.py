"""Packing token sequences by minimum bin slack over the histogram of lengths."""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, pre_tokenizers

from tickloom.llm.common import _arrow_schema, quoted, stored, text_or_empty

CAPACITY = 2048
END_ID = 0
# Bound on the words whose ids a worker remembers (about 100 MB), and how many stay when it is met.
CACHED_WORDS, KEPT_WORDS = 350_000, 120_000
# Parts of words that are tokenised at a time.
LINE_PARTS = 2000
# Fixed value: the pattern by which the vocabulary splits lower-case text into parts.
WORD_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Anything but printable ASCII and Latin letters and signs below the combining marks.
UNUSUAL = re.compile("[^\t\n\r -~¡-¬®-įĲ-ʯ]")
# Rows of one length that one lane ranks, about.
LANE_ROWS = 20_000


class _Words(dict):
    """The ids of each word between white space, as little-endian 32-bit bytes, found once.

    A word's parts (see WORD_PARTS) are tokenised many at a time: the last id of each part is one of
    a vocabulary entry that ends a word, so the ids of a line of parts fall apart again at those.
    """

    def __init__(self, tokenizer_path: str):
        super().__init__()
        self.whole = Tokenizer.from_file(tokenizer_path)
        # Added tokens have ids of their own in a text, also across words and whatever their case.
        added = [t.content for t in self.whole.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        self.line = Tokenizer.from_file(tokenizer_path)
        self.line.encode_special_tokens = True  # words without an added token come here
        self.line.normalizer = None  # words come in lower case
        bytes_only = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.line.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytes_only])
        vocabulary = self.line.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for entry, number in vocabulary.items():
            self.ends[number] = entry.endswith("</w>")
        self.parts: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > CACHED_WORDS:
            # The words that came first hold the frequent ones.
            for known in (self, self.parts):
                first = list(islice(known.items(), KEPT_WORDS))
                known.clear()
                known.update(first)
            new = [w for w in words if w not in self]
        split = [WORD_PARTS.findall(w) for w in new]
        unseen = list({p for parts in split for p in parts if p not in self.parts})
        for start in range(0, len(unseen), LINE_PARTS):
            some = unseen[start : start + LINE_PARTS]
            ids = self.ids(self.line, " ".join(some))
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
            raw = ids.tobytes()
            self.parts.update(zip(some, (raw[i:j] for i, j in zip([0, *cuts.tolist()], cuts.tolist())), strict=True))
        self.update((w, b"".join(map(self.parts.__getitem__, parts))) for w, parts in zip(new, split))

    def is_whole(self, text: str) -> bool:
        return bool(UNUSUAL.search(text) or self.added and self.added.search(text))

    @staticmethod
    def ids(tokenizer: Tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")


@cache
def _words(tokenizer_path: str) -> _Words:
    """Kept for all tasks of a worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return _Words(tokenizer_path)


def word_ids(tokenizer_path: str) -> Callable[[list[str]], Iterator[bytes]]:
    """A function from a batch of texts to their ids as little-endian 32-bit bytes.

    For a vocabulary that lower-cases and never joins across white space, a text's ids are the ids of
    its words one after the other, so each distinct word is tokenised once. Texts with characters for
    which that may not hold (combining marks, rare spaces, non-Latin letters) or with the content of an
    added token are tokenised whole.
    """
    known = _words(tokenizer_path)

    def run(texts: list[str]) -> Iterator[bytes]:
        for start in range(0, len(texts), 50):
            some = texts[start : start + 50]
            split = [None if known.is_whole(t) else t.lower().split() for t in some]
            known.learn(set().union(*filter(None, split)))
            for text, words in zip(some, split):
                if words is None:
                    yield known.ids(known.whole, text).tobytes()
                else:
                    yield b"".join(map(known.__getitem__, words))

    return run


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: its id, piece, start, length, ids_crc32, lane (and ids).

    A document is its token ids and `end_id`; longer ones are cut into pieces of `capacity` ids, of
    which the last may be shorter. A null text is empty and gives one piece of one id. `lane` deals
    the rows out evenly whatever their ids and lengths.
    """
    source = docs.select(quoted(id_col), text_or_empty(text_col).alias("text"))
    fields = "piece int, start long, length long, ids_crc32 long, lane int" + (", ids binary" if with_ids else "")
    schema = T.StructType([source.schema.fields[0], *T.StructType.fromDDL(fields).fields])
    out = _arrow_schema(schema)
    end, width = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, row = word_ids(tokenizer_path), 0
        for batch in batches:
            place, rows = [], []
            for at, text in enumerate(ids(batch.column(1).to_pylist())):
                text += end
                for piece, cut in enumerate(range(0, len(text), width)):
                    part = text[cut : cut + width]
                    place.append(at)
                    rows.append((piece, cut // 4, len(part) // 4, zlib.crc32(part), row % (1 << 30), part))
                    row += 1
            columns = list(zip(*rows))[: len(schema) - 1] if rows else [[]] * (len(schema) - 1)
            arrays = [batch.column(0).take(pa.array(place, pa.int64())).cast(out.field(0).type)]
            arrays += [pa.array(c, type=out.field(i + 1).type) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return source.mapInArrow(run, schema)


def fullest(room: int, available: dict[int, int]) -> Counter:
    """The combination of available lengths with the largest sum up to `room`; longer lengths first.

    Bit s of a bitset says that some combination has sum s. Each step adds a length a number of
    times; the bitset before each step is kept, and the best sum is traced back through them.
    """
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in available if x <= room), reverse=True):
        left, times = min(available[length], room // length), 1
        while left and not reach >> room & 1:
            times = min(times, left)
            steps.append((length, times, reach))
            reach |= (reach << (length * times)) & mask
            left -= times
            times *= 2
        if reach >> room & 1:
            break
    best, chosen = reach.bit_length() - 1, Counter()
    for length, times, before in reversed(steps):
        if not before >> best & 1:
            chosen[length] += times
            best -= length * times
    return chosen


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for `counts` pieces of each length: (how many bins, [(length, pieces of it in each)]).

    Each bin takes the longest piece left and the fullest combination beside it. The combination is
    used as often as the pieces allow before the next is sought, so that the work depends on the
    number of lengths, which `capacity` bounds, and not on the number of pieces.
    """
    left, bins = {k: v for k, v in counts.items() if v > 0}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = fullest(capacity - longest, {k: v for k, v in left.items() if v})
        left[longest] += 1
        chosen[longest] += 1
        times = min(left[k] // m for k, m in chosen.items())
        for k, m in chosen.items():
            left[k] -= m * times
            if not left[k]:
                del left[k]
        bins.append((times, sorted(chosen.items(), reverse=True)))
    return bins


def _segments(bins: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """By length, rows (first rank, first bin, pieces per bin, offset in the bin), in order of rank."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    used: Counter = Counter()
    first = 0
    for times, content in bins:
        offset = 0
        for length, each in content:
            found.setdefault(length, []).append((used[length], first, each, offset))
            used[length] += times * each
            offset += length * each
        first += times
    return {k: np.array(v, np.int64) for k, v in found.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id") -> DataFrame:
    """`pieces` with sequence_id and offset: where each goes, without gaps, in sequences of `capacity`.

    The histogram of lengths, at most `capacity` rows, is planned on the driver; every piece is
    then placed by its rank among the pieces of its length. Ranks are counted in lanes, whose sizes
    do not depend on ids or lengths, so that no length gathers in one task. Rows that are equal in
    all columns take each other's place. An empty table gives an empty one.
    """
    total = pieces.count()
    lanes = max(16, total // LANE_ROWS)
    dealt = pieces.withColumn("lane", F.pmod("lane", F.lit(lanes)))
    counts = stored(dealt.groupBy("length", "lane").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    segments = _segments(plan_bins(histogram, capacity))
    order = Window.partitionBy("length").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "lane", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "lane").orderBy(quoted(id_col), "piece", "ids_crc32")
    ranked = (
        dealt.withColumn("rank", F.row_number().over(within) - 1)
        .join(before.hint("shuffle_hash"), ["length", "lane"])
        .withColumn("rank", F.col("rank") + F.col("before"))
    )
    kept = [c for c in pieces.columns if c != "lane"]
    source = ranked.select(*kept, "rank")
    schema = T.StructType(
        [*source.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    out = _arrow_schema(schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(kept.index("length")).to_numpy()
            rank = batch.column(len(kept)).to_numpy()
            bins, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length):
                own = np.flatnonzero(length == value)
                rows = segments[int(value)]
                row = rows[np.searchsorted(rows[:, 0], rank[own], side="right") - 1]
                beyond = rank[own] - row[:, 0]
                bins[own] = row[:, 1] + beyond // row[:, 2]
                offset[own] = row[:, 3] + beyond % row[:, 2] * value
            arrays = [batch.column(i).cast(out.field(i).type) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(bins), pa.array(offset)], schema=out)

    return source.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents (see `token_pieces`) with their places (see `pack`).

    Every row is a document of its own: repeated ids and texts are packed as often as they come, and a
    null id stays null.
    """
    pieces = stored(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")
    return pack(pieces, capacity, id_col)

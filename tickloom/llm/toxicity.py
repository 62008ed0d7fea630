"""Toxicity by composed weighted finite-state transducers over clauses."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import per_text, quoted, remainder, stored, text_or_empty

# Labelled rows that a model is fitted on, at most: those with the smallest hashes of their ids.
MAX_LABELLED = 20_000
HELD_OUT, HELD_OUT_REST = 5, 0
# Word beginnings of these lengths can enter the lexicon beside whole words.
PREFIXES = (4, 5, 6, 7, 8)
# A word is learned only if this share of its documents is toxic, and of those learned about this share may
# be chance. A word counts as one of several features (itself and its beginnings).
LEAST_SHARE, LEVEL, FEATURES = 0.8, 0.05, 6
# Counts that a task holds before it hands them on.
HELD_COUNTS = 200_000
# Words that a task remembers as neither insult nor threat: those that come first, the frequent ones among them.
CACHED_WORDS = 300_000

# Word classes that hold without labels.
INSULTS = "idiot idiots moron morons stupid pathetic worthless trash scum clown loser losers disgusting dumb imbecile jerk"
THREATS = "kill hurt destroy beat stab shoot burn attack punch strangle"
TARGETS = "you your yours yourself u they them their him her these those"
NEGATIONS = "not never no isn't aren't wasn't don't doesn't didn't cannot can't without"
REPORTS = "said says wrote writes claimed claims called calls quoted quotes reported reports alleged"

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE_END = re.compile(r"[.!?;:\n]+")
# Classes of words: I insult, T threat, Y target, N negation, R reported speech, - any other word.
OTHER = "-"
SYMBOLS = "ITYNR-"

# What a matched pattern adds to the weight of its word, and the log odds of a text without any, before a
# label is seen; how firmly (as a precision) labels have to argue against them.
PATTERNS = {"insult": 0.0, "targeted": 1.0, "threat": 1.0, "negated": -6.0, "reported": -5.0}
BIAS, LEAST_BIAS, FIRM = -2.9, -4.0, 0.25
# Log odds of a text with a fixed word that no label tells more about, and the bounds of learned ones.
FIXED_INSULT, FIXED_THREAT, LEAST_ODDS, MOST_ODDS = 2.1, 0.1, 0.5, 9.0
ROUNDS = 40
# Words that the patterns look at on each side, at least.
REACH = 4


@dataclass(frozen=True)
class Transducer:
    """A weighted transducer: from (state, symbol) to any number of (state, symbol, weight).

    Weights are logarithms: along a path they are added, and paths are summed as logaddexp does. Where
    no arcs are given, the symbol passes with weight 0 and the state is `rest` of the state. A path
    counts if it ends in a state that is not in `open`.
    """

    start: object
    arcs: dict
    rest: dict = field(default_factory=dict)
    open: frozenset = frozenset()

    def step(self, state, symbol) -> tuple:
        found = self.arcs.get((state, symbol))
        return ((self.rest.get(state, state), symbol, 0.0),) if found is None else found


def compose(first: Transducer, second: Transducer, symbols: str) -> Transducer:
    """One transducer that gives what `second` makes of the output of `first` (over these symbols)."""
    start = (first.start, second.start)
    arcs, todo, seen = {}, [start], {start}
    while todo:
        a, b = state = todo.pop()
        for symbol in symbols:
            arcs[state, symbol] = found = tuple(
                ((a2, b2), out, u + v) for a2, middle, u in first.step(a, symbol) for b2, out, v in second.step(b, middle)
            )
            for target, _, _ in found:
                if target not in seen:
                    seen.add(target)
                    todo.append(target)
    return Transducer(start, arcs, {}, frozenset((a, b) for a, b in seen if a in first.open or b in second.open))


def negation(reach: int = 2) -> Transducer:
    """Marks insults at most `reach` words after a negation (i), and takes such threats out."""
    arcs = {(k, "N"): ((reach, "N", 0.0),) for k in range(reach + 1)}
    for k in range(1, reach + 1):
        arcs |= {(k, "I"): ((k - 1, "i", 0.0),), (k, "T"): ()}
    return Transducer(0, arcs, {k: max(0, k - 1) for k in range(reach + 1)})


def reported_speech() -> Transducer:
    """Marks insults after a verb of reporting, up to the end of the clause (r), and takes such threats out."""
    return Transducer(0, {(0, "R"): ((1, "R", 0.0),), (1, "I"): ((1, "r", 0.0),), (1, "i"): ((1, "r", 0.0),), (1, "T"): ()})


def target(reach: int = 3) -> Transducer:
    """Marks insults with a target at most `reach` words before or after (J), and threats with one after (D).

    What comes after is guessed: the state holds for how many more words a target goes with what follows,
    within how many a guessed one must come, and for how many none may. Wrong guesses have no path.
    """
    arcs, open_ = {}, set()
    for y in range(reach + 1):
        for must in range(reach + 1):
            for no in range(reach + 1):
                state = (y, must, no)
                if must:
                    open_.add(state)
                on = (max(0, y - 1), max(0, must - 1), max(0, no - 1))
                alive = must != 1  # the last word for a guessed target is not one
                for symbol in "-NRir":
                    arcs[state, symbol] = ((on, symbol, 0.0),) if alive else ()
                arcs[state, "Y"] = () if no else (((reach, 0, 0), "Y", 0.0),)
                with_one = (on[0], on[1] or reach, on[2])
                without = (on[0], on[1], reach)
                if not alive:
                    arcs[state, "I"] = arcs[state, "T"] = ()
                elif y:
                    arcs[state, "I"] = ((on, "J", 0.0),)
                    arcs[state, "T"] = ((with_one, "D", 0.0),)
                else:
                    arcs[state, "I"] = ((with_one, "J", 0.0), (without, "I", 0.0))
                    arcs[state, "T"] = ((with_one, "D", 0.0),)
    return Transducer((0, 0, 0), arcs, {}, frozenset(open_))


def insult(weights: dict) -> Transducer:
    """Names and weighs the insults as they were marked."""
    names = {"I": "insult", "J": "targeted", "i": "negated", "r": "reported"}
    return Transducer(0, {(0, mark): ((0, name, weights[name]),) for mark, name in names.items()})


def threat(weights: dict) -> Transducer:
    """Names and weighs threats with a target."""
    return Transducer(0, {(0, "D"): ((0, "threat", weights["threat"]),), (0, "T"): ()})


def grammar(weights: dict | None = None, without: Sequence[str] = ()) -> Transducer:
    """The machines one after the other; `without` leaves some of the first three out."""
    weights = PATTERNS if weights is None else weights
    parts = {"negation": negation(), "reported_speech": reported_speech(), "target": target()}
    made = Transducer(0, {})
    for name, part in parts.items():
        if name not in without:
            made = compose(made, part, SYMBOLS)
    return compose(compose(made, insult(weights), SYMBOLS), threat(weights), SYMBOLS)


Readings = list[list[tuple[str, float]]]


def weigh(machine: Transducer, readings: Readings) -> tuple[float, float, tuple]:
    """(log of the sum of all paths' weights, the heaviest path's weight, its outputs) over words that each
    have any number of (class, weight)."""
    held = {machine.start: (0.0, 0.0, None)}
    for word in readings:
        after: dict = {}
        for state, (total, best, outputs) in held.items():
            for symbol, weight in word:
                for nxt, out, w in machine.step(state, symbol):
                    w += weight
                    made = (total + w, best + w, (outputs, out) if out in PATTERNS else outputs)
                    old = after.get(nxt)
                    if old is not None:
                        high, low = max(old[0], made[0]), min(old[0], made[0])
                        made = (high + math.log1p(math.exp(low - high)), *(old if old[1] >= made[1] else made)[1:])
                    after[nxt] = made
        held = after
    ends = [found for state, found in held.items() if state not in machine.open]
    if not ends:
        return -math.inf, -math.inf, ()
    high = max(e[0] for e in ends)
    _, best, outputs = max(ends, key=lambda e: e[1])
    named = []
    while outputs is not None:
        outputs, out = outputs
        named.append(out)
    return high + math.log(sum(math.exp(e[0] - high) for e in ends)), best, tuple(named[::-1])


@dataclass(frozen=True)
class Model:
    """Learned words and beginnings of insults with the log odds of a text that has one, fixed insults taken
    out, the weights of patterns, and the log odds of a text without any match. A word weighs the difference
    of both odds, so that one match gives a text the odds of its word."""

    words: dict = field(default_factory=dict)
    beginnings: dict = field(default_factory=dict)
    harmless: frozenset = frozenset()
    weights: dict = field(default_factory=lambda: dict(PATTERNS))
    bias: float = BIAS


class Lexicon:
    """The readings of words: what a transducer over their characters gives.

    Its arcs are a trie. At the end of a word, the node gives the classes of that very word; a node where
    a beginning ends gives its class whatever characters follow. Insults and threats may also be read as
    any other word, with weight 0.
    """

    def __init__(self, model: Model):
        self.arcs: dict[tuple[int, str], int] = {}
        self.whole: dict[int, list[tuple[str, float]]] = {}
        self.begun: dict[int, list[tuple[str, float]]] = {}
        self.nodes = 1
        self.heads: set[str] = set()
        self.quiet: set[str] = set()
        for symbol, words in (("R", REPORTS), ("N", NEGATIONS), ("Y", TARGETS)):
            for word in words.split():
                self.add(word, symbol, 0.0, self.whole)
        for word in THREATS.split():
            self.add(word, "T", FIXED_THREAT - model.bias, self.whole)
        fixed = {w: FIXED_INSULT for w in INSULTS.split() if w not in model.harmless}
        fixed = {w: x for w, x in fixed.items() if not any(w[:k] in model.beginnings for k in PREFIXES)}
        for word, odds in (fixed | model.words).items():
            self.add(word, "I", odds - model.bias, self.whole)
        for start, odds in model.beginnings.items():
            self.add(start, "I", odds - model.bias, self.begun)

    def add(self, letters: str, symbol: str, weight: float, ends: dict) -> None:
        node = 0
        for letter in letters:
            node = self.arcs.setdefault((node, letter), self.nodes)
            self.nodes = max(self.nodes, node + 1)
        ends.setdefault(node, []).append((symbol, weight))
        self.heads.add(letters[:3])

    def read(self, word: str) -> list[tuple[str, float]]:
        if word[:3] not in self.heads:  # no arcs lead even that far
            return [(OTHER, 0.0)]
        node, found = 0, []
        for letter in word:
            node = self.arcs.get((node, letter), -1)
            if node < 0:
                break
            found += self.begun.get(node, ())
        else:
            found += self.whole.get(node, ())
        sure = [r for r in found if r[0] in "YNR"]
        return sure[:1] or [*found, (OTHER, 0.0)]

    def speaks(self, words: set[str]) -> bool:
        """Whether any of the words can be an insult or a threat."""
        new = words - self.quiet
        if not new:
            return False
        loud = {w for w in new if w[:3] in self.heads and len(self.read(w)) > 1}
        if len(self.quiet) < CACHED_WORDS:
            self.quiet |= new - loud
        return bool(loud)


@dataclass(frozen=True)
class Found:
    """The log odds of a toxic text, and how often each pattern is on the heaviest paths of its clauses."""

    odds: float
    patterns: Counter

    @property
    def pattern(self) -> str:
        return max(self.patterns, key=lambda p: (self.patterns[p], p)) if self.patterns else "none"


def _clauses(text: str, lexicon: Lexicon) -> Iterator[Readings]:
    """The clauses that have an insult or a threat."""
    text = text.lower().replace("’", "'")
    if lexicon.speaks(set(WORD.findall(text))):
        for clause in CLAUSE_END.split(text):
            words = WORD.findall(clause)
            if lexicon.speaks(set(words)):
                yield [lexicon.read(w) for w in words]


def matcher(model: Model, without: Sequence[str] = ()) -> Callable[[str], Found]:
    """A function that sums the weights of a text's matched clauses."""
    lexicon, machine = Lexicon(model), grammar(model.weights, without)

    def run(text: str) -> Found:
        odds, patterns = model.bias, Counter()
        for readings in _clauses(text, lexicon):
            total, _, outputs = weigh(machine, readings)
            odds += total
            patterns.update(outputs)
        return Found(odds, patterns)

    return run


def _matches(text: str, lexicon: Lexicon, machine: Transducer) -> Iterator[tuple[str, float]]:
    """(pattern, word's weight) of each insult and threat; the paths of a clause are their combinations.

    What a word is named depends on the words within REACH, and on whether one of reporting came before.
    """
    for readings in _clauses(text, lexicon):
        plain = [r if len(r) == 1 else [(OTHER, 0.0)] for r in readings]
        reported: list = []
        for k, reading in enumerate(readings):
            if k > REACH and plain[k - REACH - 1][0][0] == "R":
                reported = [plain[k - REACH - 1]]
            for symbol, weight in reading if len(reading) > 1 else ():
                if symbol != OTHER:
                    near = [*reported, *plain[max(0, k - REACH) : k], [(symbol, weight)], *plain[k + 1 : k + REACH + 1]]
                    _, _, outputs = weigh(machine, near)
                    yield from ((p, weight) for p in outputs)


def labelled(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """(text, toxic) of at most `limit` labelled rows that are not held out; each different text once."""
    rows = (
        labels.where(F.col("toxic").isNotNull() & (remainder(F.col("doc_id"), HELD_OUT) != HELD_OUT_REST))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
        .select(F.col("doc_id").alias("label_id"), "toxic")
    )
    met = docs.select(quoted("doc_id").alias("id"), text_or_empty().alias("text")).join(
        F.broadcast(rows),  # `limit` rows at most
        F.col("id") == F.col("label_id"),
    )
    once = met.groupBy(F.xxhash64("text").alias("key"), "toxic").agg(F.first("text").alias("text"))
    return stored(once.select("text", "toxic"), "labelled")


def _features(word: str) -> Iterator[str]:
    yield word
    for k in PREFIXES:
        if len(word) >= k:
            yield f"{word[:k]}*"


def _unlikely(toxic: float, clean: float, share: float) -> float:
    """Minus the log of a bound on the chance of so many toxic rows at this base share."""
    n = toxic + clean
    if not n or toxic / n <= share:
        return 0.0
    part = clean * math.log(clean / n / (1 - share)) if clean else 0.0
    return toxic * math.log(toxic / n / share) + part


def _learned(unlikely: dict[str, float], tried: int) -> set[str]:
    """Those whose chance is so small that of all taken about LEVEL are expected to be false (by ranks)."""
    ranked = sorted(unlikely.items(), key=lambda f: (-f[1], f[0]))
    least = [math.log(max(tried, 1) * FEATURES / (LEVEL * (k + FEATURES))) for k in range(len(ranked))]
    last = max((k for k, (_, u) in enumerate(ranked) if u >= least[k]), default=-1)
    return {f for f, _ in ranked[: last + 1]}


def _learn_words(rows: DataFrame, toxic: int, clean: int) -> tuple[dict, set]:
    """Words and beginnings (`stem*`) that mark toxic rows, with the log odds of rows that have them, and fixed
    insults that do not.

    Documents are counted for each word and each beginning; what chance could explain, given how many
    were tried, is left out. Near copies would count many times for one text, so a word must also
    reach the level when each neighbourhood (word before, word after) counts once.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: list[Counter] = [Counter(), Counter()]

        def out() -> pa.RecordBatch:
            keys = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array(keys, pa.string()), *(pa.array([counts[y][k] for k in keys], pa.int64()) for y in (1, 0))]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, names=["feature", "toxic", "clean"])

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[int(y == 1)].update({f for w in set(WORD.findall(text.lower())) for f in _features(w)})
                if len(counts[0]) + len(counts[1]) > HELD_COUNTS:
                    yield out()
        yield out()

    fields = "feature string, toxic long, clean long"
    counted = stored(
        rows.mapInArrow(count, fields).groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "word-counts",
    )
    share = toxic / (toxic + clean)
    tried = counted.count()
    # The labelled rows are bounded, and so is the list of features that several toxic ones share.
    least = max(3, math.floor(math.log(max(tried, 1) / 1000) / math.log(1 / share)))
    frequent = counted.where((F.col("toxic") >= least) & (F.col("toxic") >= LEAST_SHARE * (F.col("toxic") + F.col("clean"))))
    seen = {r["feature"]: (r["toxic"], r["clean"]) for r in frequent.collect()}
    candidates = _learned({f: _unlikely(t, c, share) for f, (t, c) in seen.items()}, tried)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text in batch.column(0).to_pylist():
                words = ["", *WORD.findall(text.lower()), ""]
                for k in range(1, len(words) - 1):
                    found.update((f, words[k - 1], words[k + 1]) for f in _features(words[k]) if f in candidates)
            columns = [pa.array(list(c), pa.string()) for c in (zip(*found) if found else ([], [], []))]
            yield pa.RecordBatch.from_arrays(columns, names=["feature", "before", "after"])

    places = rows.where("toxic = 1").mapInArrow(around, "feature string, before string, after string")
    apart = {r["feature"]: r["n"] for r in places.distinct().groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    once = {f: (min(seen[f][0], apart.get(f, 0)), seen[f][1]) for f in candidates}
    strong = _learned({f: _unlikely(t, c, share) for f, (t, c) in once.items()}, tried)
    # Of beginnings that mark the same rows the longest stays; words that a beginning covers are left out.
    stems = {f[:-1]: seen[f][0] for f in strong if f.endswith("*")}
    longest = {s for s, n in stems.items() if not any(t != s and t.startswith(s) and m >= 0.98 * n for t, m in stems.items())}
    general = {s for s in longest if not any(s != t and s.startswith(t) for t in longest)}
    words = {f for f in strong if not f.endswith("*") and not any(f[:k] in general for k in PREFIXES)}

    def odds(counts: tuple[float, float]) -> float:
        return min(MOST_ODDS, max(LEAST_ODDS, math.log((counts[0] + 0.5) / (counts[1] + 0.5))))

    fixed = counted.where(F.col("feature").isin(INSULTS.split())).collect()
    harmless = {r["feature"] for r in fixed if r["clean"] >= 5 and r["toxic"] < 0.5 * (r["toxic"] + r["clean"])}
    return {f: odds(once[f]) for f in words | {f"{s}*" for s in general}}, harmless


def _train(matches: list[tuple[int, list[str], list[float]]], bias: float) -> dict:
    """The weights of patterns under which the labels (label, patterns, word weights) are likeliest.

    A text's log odds are the bias and, for each match, log(1 + exp(word's weight + pattern's weight)):
    the sum over the paths with and without it. Newton's method, drawn to the weights before labels; where
    words weigh more, what takes their weight back does too.
    """
    names = list(PATTERNS)
    start = np.array([w + (bias - BIAS if p in ("negated", "reported") else 0.0) for p, w in PATTERNS.items()])
    label = np.array([y for y, _, _ in matches], float)
    text = np.repeat(np.arange(len(matches)), [len(p) for _, p, _ in matches])
    kind = np.array([names.index(p) for _, found, _ in matches for p in found], int)
    word = np.array([w for _, _, found in matches for w in found], float)
    at = start.copy()
    for _ in range(ROUNDS if len(kind) else 0):
        lifted = word + at[kind]
        odds = bias + np.bincount(text, np.logaddexp(0, lifted), len(matches))
        chance = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        slope = np.zeros((len(matches), len(at)))
        np.add.at(slope, (text, kind), 1 / (1 + np.exp(-lifted)))
        ascent = slope.T @ (label - chance) - FIRM * (at - start)
        bend = (slope * (chance * (1 - chance))[:, None]).T @ slope + FIRM * np.eye(len(at))
        step = np.linalg.solve(bend, ascent)
        at += step / max(1.0, np.abs(step).max())
    return dict(zip(names, at.tolist()))


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Model:
    """A model from the labelled rows that are not held out (see `labelled`).

    Without labels of both kinds the fixed words and odds are used.
    """
    rows = labelled(docs, labels, limit)
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(1) or not counts.get(0):
        return Model()
    learned, harmless = _learn_words(rows, counts[1], counts[0])
    model = Model(
        {f: w for f, w in learned.items() if not f.endswith("*")},
        {f[:-1]: w for f, w in learned.items() if f.endswith("*")},
        frozenset(harmless),
    )

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, machine = Lexicon(model), grammar()
        for batch in batches:
            found = [list(_matches(t, lexicon, machine)) for t in batch.column(0).to_pylist()]
            columns = [
                batch.column(1).cast(pa.int32()),
                pa.array([[p for p, _ in f] for f in found], pa.list_(pa.string())),
                pa.array([[w + model.bias for _, w in f] for f in found], pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["y", "p", "w"])

    # One row per labelled text, of which there are `limit` at most.
    matched = rows.mapInArrow(patterns, "y int, p array<string>, w array<double>").orderBy("y", "p", "w").collect()
    quiet = Counter(r["y"] == 1 for r in matched if not r["p"])
    bias = max(LEAST_BIAS, min(BIAS, math.log((quiet[True] + 0.5) / (quiet[False] + 0.5))))
    texts = [(int(r["y"] == 1), r["p"], [odds - bias for odds in r["w"]]) for r in matched if r["p"]]
    return replace(model, weights=_train(texts, bias), bias=bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted, pattern, n_matches) per row of `docs`.

    Words are read by a lexicon transducer over their characters, and clauses with an insult or a threat
    run through the composed grammar. The log odds of a text are the bias and, for each such clause, the
    log of the summed weights of all its paths, the one without a match having weight 0. `pattern` is the
    commonest on the heaviest paths. A text without a match, an empty text and a null text have the odds
    of the bias. Every row gives one row, repeated and null ids included.
    """

    def make():
        match = matcher(model)

        def run(texts: list[str]) -> dict[str, list]:
            found = [match(t) for t in texts]
            chances = [1 / (1 + math.exp(-min(max(f.odds, -700), 700))) for f in found]
            return {
                "score": chances,
                "predicted": [int(c >= 0.5) for c in chances],
                "pattern": [f.pattern for f in found],
                "n_matches": [f.patterns.total() for f in found],
            }

        return run

    return per_text(docs, make, "score double, predicted int, pattern string, n_matches long", id_col, text_col)


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `model` does not take for toxic, with all their columns.

    Rows are judged one by one by their text; null and empty texts stay.
    """
    text_at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = matcher(model)
        for batch in batches:
            clean = [match(t or "").odds < 0 for t in batch.column(text_at).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)

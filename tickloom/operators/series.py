"""Ordered series at scale: windows per symbol without a task per symbol.

`Window.partitionBy(symbol)` sends a whole symbol to one task. Here a symbol with more
rows than one task should hold is cut along time into chunks, and each chunk also gets a
copy of the `look_back` rows before it (its halo). A window over (symbol, chunk) then sees
every row that a bounded frame can reach, so results are the same as over the whole symbol.

Cost: one pass counts the rows per symbol, with map-side combining and two columns read. When no
symbol is large, the plain window follows. Else one more such pass counts slices of the large
symbols, a third only if some slice is itself too large, and then the data is shuffled once, as for
the plain window. The small tables that the passes give are stored, so that none is made twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import store

CHUNK = "_chunk"
HALO = "_halo"


@dataclass(frozen=True)
class Split:
    """How large symbols are cut.

    A symbol is cut when it has more than L rows, L = max(`rows`, all rows / `max_chunks`). Its
    time span is counted in equal slices, `slices` per expected chunk; a slice that still has
    more than L rows (a burst, or a stray date that stretches the span) is counted again in
    equal steps between its own first and last time, or along the tie-breaker when all its rows
    have one time or none. Consecutive slices then form chunks of about L rows.

    At most `max_chunks` symbols and `max_chunks` slices exceed L, and they are cut into at most
    4 * `slices` * `max_chunks` pieces in all. This bounds the broadcast tables whatever the size
    of the data: a million short rows with the defaults.
    """

    rows: int = 1_000_000
    max_chunks: int = 131_072
    slices: int = 2


DEFAULT_SPLIT = Split()


def as_keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def split_series(
    df: DataFrame,
    keys: str | Sequence[str] = "symbol",
    order: Sequence[str] = ("ts", "seq"),
    look_back: int = 0,
    totals: Mapping[str, Column] | None = None,
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """`cut_series`, without its frame."""
    return cut_series(df, keys, order, look_back, totals, split)[0]


def cut_series(
    df: DataFrame,
    keys: str | Sequence[str] = "symbol",
    order: Sequence[str] = ("ts", "seq"),
    look_back: int = 0,
    totals: Mapping[str, Column] | None = None,
    split: Split = DEFAULT_SPLIT,
    at_most: int | None = None,
) -> tuple[DataFrame, Frame]:
    """Add `_chunk` and `_halo` (true for copied rows) to every row; also gives the window's frame.

    `order[0]` is a timestamp; the rest of `order` breaks ties and must make it total.
    For each entry of `totals` the column of that name holds the sum of the expression
    over all rows of the symbol before the row's chunk (null where none has a value).
    Runs the counting jobs at once, to see whether anything must be cut, unless `at_most` rows are few.
    """
    keys = as_keys(keys)
    totals = dict(totals or {})
    at = f"unix_micros(CAST(`{order[0]}` AS TIMESTAMP)) AS _at"
    tie = f"{_tie_breaker(df, order)} AS _tie"
    lean = df.select(*keys, F.expr(at), F.expr(tie), *[value.alias(name) for name, value in totals.items()])

    kinds = {t: per_sum.dataType for t, per_sum in zip(totals, lean.agg(*[F.sum(t).alias(t) for t in totals]).schema)} if totals else {}
    per_key = lean.groupBy(*keys).agg(F.expr("count(1) AS _n"), F.expr("min(_at) AS _lo"), F.expr("max(_at) AS _hi"))
    rows = max(split.rows, look_back + 1)
    if at_most is not None and at_most <= rows:
        return _uncut(df, keys, order, kinds)
    per_key = store(per_key, "series_keys")
    most, total = per_key.agg(F.max("_n"), F.sum("_n")).first()
    limit = max(rows, -(-(total or 0) // split.max_chunks))
    if (most or 0) <= limit:
        return _uncut(df, keys, order, kinds)
    large = (
        per_key.withColumn("_limit", F.lit(limit).cast("bigint"))
        .where("_n > _limit")
        .selectExpr(
            *[f"`{k}` AS `_l_{k}`" for k in keys], "_lo", "_limit", f"{_step('_lo', '_hi', split.slices)} AS _width"
        )
    )

    of_large = lean.join(F.broadcast(large), F.expr(_same(keys, "_l_"))).selectExpr("*", f"{_SLICE} AS _slice")
    slices = store(_count_slices(of_large, keys, list(totals)), "series_slices")
    busy = store(_busy_slices(slices, keys, split.slices), "series_busy")
    if busy.isEmpty():
        counted = slices.withColumn("_piece", F.lit(0).cast("bigint"))
    else:
        counted = _count_pieces(of_large, busy, keys, list(totals))
    chunks = store(_chunk_table(counted, keys, look_back, list(totals)), "series_chunks")

    own_columns = [f"`{c}`" for c in df.columns]
    cut = (
        df.select("*", F.expr(at), F.expr(tie))
        .join(F.broadcast(large.drop("_limit")), F.expr(_same(keys, "_l_")), "left")
        .selectExpr(*own_columns, "_at", "_tie", f"{_SLICE} AS _slice")
        .join(F.broadcast(busy), F.expr(_same([*keys, "_slice"], "_b_")), "left")
        .selectExpr(*own_columns, "_slice", f"{_PIECE} AS _piece")
        .join(F.broadcast(chunks), F.expr(_same([*keys, "_slice", "_piece"], "_c_")), "left")
        .selectExpr(
            *own_columns,
            *[f"CAST(`_t_{t}` AS {kind.simpleString()}) AS `{t}`" for t, kind in kinds.items()],
            "coalesce(_targets[0], 0L) AS _own",
            f"explode(coalesce(_targets, array(0L))) AS {CHUNK}",
        )
        .selectExpr("* EXCEPT (_own)", f"{CHUNK} <> _own AS {HALO}")
    )
    return cut, Frame(tuple(keys), tuple(order), True)


def _uncut(df: DataFrame, keys: list[str], order: Sequence[str], kinds: Mapping[str, T.DataType]) -> tuple[DataFrame, Frame]:
    nothing = [F.lit(None).cast(kind).alias(t) for t, kind in kinds.items()]
    whole = df.select("*", *nothing, F.lit(0).cast("bigint").alias(CHUNK), F.lit(False).alias(HALO))
    return whole, Frame(tuple(keys), tuple(order), False)


def _tie_breaker(df: DataFrame, order: Sequence[str]) -> str:
    """The second order column as an integer that grows with it, so that it can be cut into steps.

    Of text, the first seven bytes count; texts that share them, and types without such a number,
    are not cut apart.
    """
    kind = df.schema[order[1]].dataType if len(order) > 1 else None
    if isinstance(kind, T.IntegralType):
        return f"CAST(`{order[1]}` AS BIGINT)"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"unix_micros(CAST(`{order[1]}` AS TIMESTAMP))"
    if isinstance(kind, T.DateType):
        return f"CAST(unix_date(`{order[1]}`) AS BIGINT)"
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return f"CAST(conv(rpad(substr(hex(CAST(`{order[1]}` AS BINARY)), 1, 14), 14, '0'), 16, 10) AS BIGINT)"
    return "CAST(NULL AS BIGINT)"


def _step(lo: str, hi: str, slices: int) -> str:
    return f"greatest(1L, CAST(ceil((CAST({hi} AS DOUBLE) - {lo} + 1) / ({slices} * ceil(_n / _limit))) AS BIGINT))"


# Null times and null tie-breakers sort first, hence -1. Rows of small symbols have no slice.
_SLICE = "CASE WHEN _width IS NOT NULL THEN coalesce((_at - _lo) div _width, -1L) END"
_PIECE = "CASE WHEN _step IS NULL THEN 0L ELSE coalesce((CASE WHEN _by_tie THEN _tie ELSE _at END - _from) div _step, -1L) END"


def _same(keys: Sequence[str], prefix: str) -> str:
    return " AND ".join(f"`{k}` <=> `{prefix}{k}`" for k in keys)


def _count_slices(of_large: DataFrame, keys: list[str], totals: list[str]) -> DataFrame:
    return of_large.groupBy(*keys, "_slice", "_limit").agg(
        F.expr("count(1) AS _n"),
        F.expr("min(_at) AS _at_lo"),
        F.expr("max(_at) AS _at_hi"),
        F.expr("min(_tie) AS _tie_lo"),
        F.expr("max(_tie) AS _tie_hi"),
        *[F.expr(f"sum(`{t}`) AS `{t}`") for t in totals],
    )


def _count_pieces(of_large: DataFrame, busy: DataFrame, keys: list[str], totals: list[str]) -> DataFrame:
    return (
        of_large.join(F.broadcast(busy), F.expr(_same([*keys, "_slice"], "_b_")), "left")
        .selectExpr("*", f"{_PIECE} AS _piece")
        .groupBy(*keys, "_slice", "_piece", "_limit")
        .agg(F.expr("count(1) AS _n"), *[F.expr(f"sum(`{t}`) AS `{t}`") for t in totals])
    )


def _busy_slices(counted: DataFrame, keys: list[str], slices: int) -> DataFrame:
    """The slices with more than L rows, and the steps in which they are counted again."""
    return (
        counted.where("_n > _limit")
        .selectExpr("*", "_at_lo <=> _at_hi AS _by_tie")
        .selectExpr(
            *[f"`{k}` AS `_b_{k}`" for k in keys],
            "_slice AS _b__slice",
            "_by_tie",
            "CASE WHEN _by_tie THEN _tie_lo ELSE _at_lo END AS _from",
            f"""CASE WHEN NOT _by_tie THEN {_step('_at_lo', '_at_hi', slices)}
                WHEN _tie_lo IS NOT NULL THEN {_step('_tie_lo', '_tie_hi', slices)} END AS _step""",
        )
    )


def _chunk_table(counted: DataFrame, keys: list[str], look_back: int, totals: list[str]) -> DataFrame:
    """(key, slice, piece) of the large symbols -> the chunks its rows belong to, own chunk first."""
    by_key = ", ".join(f"`{k}`" for k in keys)
    earlier = f"OVER (PARTITION BY {by_key} ORDER BY _slice, _piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    placed = (
        counted.selectExpr(
            *[f"`{k}`" for k in keys],
            "_slice",
            "_piece",
            f"coalesce(sum(_n) {earlier}, 0L) AS _before",
            "_n",
            "_limit",
            *[f"sum(`{t}`) {earlier} AS `{t}`" for t in totals],
        )
        .selectExpr("*", "_before div _limit AS _own", "_before + _n AS _end")
        .selectExpr("*", f"lead(_own) OVER (PARTITION BY {by_key} ORDER BY _slice, _piece) AS _next")
    )
    # A chunk that starts within `look_back` rows after a piece needs the piece's rows.
    halo = (
        f"""collect_list(CASE WHEN _next <> _own THEN _next END) OVER (
            PARTITION BY {by_key} ORDER BY _end RANGE BETWEEN CURRENT ROW AND {look_back - 1} FOLLOWING)"""
        if look_back
        else "array()"
    )
    return placed.selectExpr(
        *[f"`{k}` AS `_c_{k}`" for k in keys],
        "_slice AS _c__slice",
        "_piece AS _c__piece",
        f"concat(array(_own), {halo}) AS _targets",
        *[f"first(`{t}`) OVER (PARTITION BY {by_key}, _own ORDER BY _slice, _piece) AS `_t_{t}`" for t in totals],
    )


@dataclass(frozen=True)
class Frame:
    """The window over a symbol's chunk. As text it is `PARTITION BY ... ORDER BY ...`.

    `cut` says whether any symbol is cut, so that rows before a chunk lie in other chunks.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cut: bool

    @property
    def partition(self) -> str:
        return ", ".join(f"`{c}`" for c in (*self.keys, *([CHUNK] if self.cut else [])))

    @property
    def ordering(self) -> str:
        return ", ".join(f"`{c}`" for c in self.order)

    def __str__(self) -> str:
        return f"PARTITION BY {self.partition} ORDER BY {self.ordering}"


def drop_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col(HALO)).drop(CHUNK, HALO)

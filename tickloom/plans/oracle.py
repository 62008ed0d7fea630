"""DuckDB SQL for the registered queries, over the same Parquet tables."""

from __future__ import annotations

from tickloom.schema import MONTH_CODES, SERVICES, SORT_FIELDS

_EVENTS = """events_k AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""

_TICKS = f"""{_EVENTS}, ticks AS (
  SELECT event_type AS symbol, ts, event_id AS seq, value AS price, value AS close, CAST(k AS DOUBLE) AS volume
  FROM events_k)"""

_BARS = f"""{_TICKS}, bars AS (
  SELECT symbol, date_trunc('hour', ts) AS date, arg_min(price, seq) AS open, max(price) AS high,
         min(price) AS low, arg_max(price, seq) AS close, sum(volume) AS volume, count(*) AS trades
  FROM ticks GROUP BY ALL)"""

_SERVICE = "[" + ", ".join(f"'{s}'" for s in SERVICES) + f"][1 + user_id % {len(SERVICES)}]"


def _sma_trend(select: str) -> str:
    return f"""WITH {_TICKS}, averaged AS (
  SELECT symbol, ts, seq, close, avg(close) OVER (
    PARTITION BY symbol ORDER BY ts, seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS sma FROM ticks),
trended AS (
  SELECT *, sma - lag(sma) OVER (PARTITION BY symbol ORDER BY ts, seq) AS d FROM averaged),
labelled AS (
  SELECT symbol, ts, seq, close, sma,
         CASE WHEN d > 0 THEN 'up' WHEN d < 0 THEN 'down' ELSE 'flat' END AS trend FROM trended)
{select}"""


_SMA_FULL = f"""WITH {_TICKS}, averaged AS (
  SELECT symbol, ts, seq, price, avg(price) OVER w AS sma, count(price) OVER w AS n FROM ticks
  WINDOW w AS (PARTITION BY symbol ORDER BY ts, seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT symbol, ts, seq, price, sma FROM averaged WHERE n = 3"""

_RSI = f"""WITH {_TICKS}, moved AS (
  SELECT symbol, ts, seq, close, close - lag(close) OVER (PARTITION BY symbol ORDER BY ts, seq) AS d FROM ticks),
averaged AS (
  SELECT symbol, ts, seq, close, count(d) OVER w AS n,
         avg(CASE WHEN d > 0 THEN d WHEN d IS NOT NULL THEN 0 END) OVER w AS g,
         avg(CASE WHEN d < 0 THEN -d WHEN d IS NOT NULL THEN 0 END) OVER w AS l
  FROM moved WINDOW w AS (PARTITION BY symbol ORDER BY ts, seq ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT symbol, ts, seq, close, round(CASE WHEN n < 14 THEN NULL WHEN l > 0 THEN 100 - 100 / (1 + g / l)
       WHEN g > 0 THEN 100.0 END, 6) AS rsi FROM averaged"""

_RSI_WILDER = f"""WITH RECURSIVE {_BARS}, moved AS (
  SELECT symbol, date, close, row_number() OVER w AS rn, close - lag(close) OVER w AS d
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)),
smoothed AS (
  SELECT symbol, rn, greatest(d, 0.0) AS g, greatest(-d, 0.0) AS l FROM moved WHERE rn = 2
  UNION ALL
  SELECT m.symbol, m.rn, greatest(m.d, 0.0) / 14 + s.g * 13 / 14, greatest(-m.d, 0.0) / 14 + s.l * 13 / 14
  FROM smoothed s JOIN moved m ON m.symbol = s.symbol AND m.rn = s.rn + 1)
SELECT m.symbol, m.date, m.close, round(CASE WHEN m.rn < 15 THEN NULL WHEN l > 0 THEN 100 - 100 / (1 + g / l)
       WHEN g > 0 THEN 100.0 END, 6) AS rsi
FROM moved m LEFT JOIN smoothed s ON s.symbol = m.symbol AND s.rn = m.rn"""


def _macd_ctes(source: str, order: str) -> str:
    return f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {order}) AS rn FROM {source}),
smoothed AS (
  SELECT symbol, rn, close AS fast, close AS slow, CAST(0.0 AS DOUBLE) AS signal FROM numbered WHERE rn = 1
  UNION ALL
  SELECT symbol, rn, fast, slow, 0.2 * (fast - slow) + 0.8 * signal FROM (
    SELECT n.symbol, n.rn, s.signal, CAST(2 AS DOUBLE) / 13 * n.close + CAST(11 AS DOUBLE) / 13 * s.fast AS fast,
           CAST(2 AS DOUBLE) / 27 * n.close + CAST(25 AS DOUBLE) / 27 * s.slow AS slow
    FROM smoothed s JOIN numbered n ON n.symbol = s.symbol AND n.rn = s.rn + 1))"""


_MACD_COLUMNS = """round(fast - slow, 6) AS macd, round(signal, 6) AS macd_signal,
  round(fast - slow - signal, 6) AS macd_hist"""

_MACD = f"""WITH RECURSIVE {_BARS}, {_macd_ctes('bars', 'date')}
SELECT symbol, date, close, {_MACD_COLUMNS} FROM numbered JOIN smoothed USING (symbol, rn)"""

_MACD_TICKS = f"""WITH RECURSIVE {_TICKS}, {_macd_ctes('ticks', 'ts, seq')}
SELECT symbol, ts, seq, close, {_MACD_COLUMNS} FROM numbered JOIN smoothed USING (symbol, rn)"""

_BOLLINGER = f"""WITH {_TICKS}, banded AS (
  SELECT symbol, ts, seq, close, count(close) OVER w AS n, avg(close) OVER w AS m, stddev_samp(close) OVER w AS s
  FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY ts, seq ROWS BETWEEN 14 PRECEDING AND CURRENT ROW))
SELECT symbol, ts, seq, close, CASE WHEN n = 15 THEN round(m, 6) END AS bb_mid,
       CASE WHEN n = 15 THEN round(m + 2 * s, 6) END AS bb_upper,
       CASE WHEN n = 15 THEN round(m - 2 * s, 6) END AS bb_lower FROM banded"""

_PRICE_DIFF = f"""WITH {_TICKS}
SELECT symbol, ts, seq, close, close - lag(close) OVER (PARTITION BY symbol ORDER BY ts, seq) AS change FROM ticks"""

_CUMULATIVE = f"""WITH {_TICKS}, scaled AS (SELECT symbol, ts, seq, 100 + 5 * price AS price FROM ticks)
SELECT symbol, ts, seq, round(price, 6) AS price, CAST(sum(CAST(price AS DECIMAL(18, 2))) OVER (
  PARTITION BY symbol ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS DECIMAL(28, 2)) AS total FROM scaled"""

_VOLUME_DIRECTION = f"""WITH {_BARS}, before AS (
  SELECT symbol, date, close, volume, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS p FROM bars)
SELECT symbol, date, close, volume, CASE WHEN close >= p THEN 'up' WHEN close < p THEN 'down' END AS volume_direction
FROM before"""

_STUDIES_TAIL = f"""WITH RECURSIVE {_BARS}, tail AS (
  SELECT symbol, date, close, volume FROM bars
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 60),
{_macd_ctes('tail', 'date')}, moved AS (
  SELECT symbol, rn, date, close, volume, lag(close) OVER w AS p, close - lag(close) OVER w AS d
  FROM numbered WINDOW w AS (PARTITION BY symbol ORDER BY rn)),
averaged AS (
  SELECT *, count(d) OVER w AS n, avg(CASE WHEN d > 0 THEN d WHEN d IS NOT NULL THEN 0 END) OVER w AS g,
         avg(CASE WHEN d < 0 THEN -d WHEN d IS NOT NULL THEN 0 END) OVER w AS l
  FROM moved WINDOW w AS (PARTITION BY symbol ORDER BY rn ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT symbol, date, close, volume, round(CASE WHEN n < 14 THEN NULL WHEN l > 0 THEN 100 - 100 / (1 + g / l)
       WHEN g > 0 THEN 100.0 END, 6) AS rsi, {_MACD_COLUMNS},
       CASE WHEN close >= p THEN 'up' WHEN close < p THEN 'down' END AS volume_direction
FROM averaged JOIN smoothed USING (symbol, rn)"""

_ROUTE_COUNTS = f"""WITH {_EVENTS}
SELECT CASE k WHEN 0 THEN 'notify' WHEN 1 THEN 'response' ELSE 'data' END AS route, count(*) AS n
FROM events_k GROUP BY 1"""

_FLATTEN = f"""WITH {_EVENTS}
SELECT {_SERVICE} AS service, event_type AS symbol, date_trunc('millisecond', ts) AS date,
       CAST(NULL AS DOUBLE) AS open, CAST(NULL AS DOUBLE) AS high, CAST(NULL AS DOUBLE) AS low, value AS close,
       k AS volume, value AS "lastPrice", CAST(NULL AS DOUBLE) AS "bidPrice", CAST(NULL AS INTEGER) AS "bidSize",
       CAST(NULL AS DOUBLE) AS "askPrice", CAST(NULL AS INTEGER) AS "askSize"
FROM events_k WHERE k > 1"""

_PARSE_BARS = f"""WITH {_EVENTS}
SELECT event_type AS symbol, ts AS date, value AS open, value AS high, value AS low,
       CASE WHEN k <> 4 THEN value END AS close, CAST(k AS DOUBLE) AS volume
FROM events_k WHERE k > 3"""

_REJECTED = f"""WITH {_EVENTS}
SELECT CASE k WHEN 0 THEN 'malformed' WHEN 1 THEN 'empty' WHEN 2 THEN 'malformed' ELSE 'bad_field' END
       AS reject_reason, count(*) AS n FROM events_k WHERE k <= 3 GROUP BY 1"""

_TICK_JSON = f"WITH {_TICKS} SELECT symbol, ts AS date, close, volume FROM ticks"

_LINES = f"""WITH {_BARS}
SELECT 'bars,stock=' || symbol || ' open=' || open || ',high=' || high || ',low=' || low || ',close=' || close
       || ',volume=' || volume || ' ' || epoch_ms(date) AS line FROM bars"""

_POINTS = f"""WITH {_BARS}
SELECT 'bars' AS measurement, date AS time, symbol AS stock, open, high, low, close, volume FROM bars"""

_EVEN = ", ".join(f"'{s}'" for s in SERVICES[::2])

_SUBSCRIBE = f"""WITH {_EVENTS}, sent AS (
  SELECT {_SERVICE} AS service, * FROM events_k WHERE k > 1)
SELECT service, event_type AS symbol, date_trunc('millisecond', ts) AS date, value AS "lastPrice",
       CASE WHEN service IN ({_EVEN}) THEN k END AS volume,
       CASE WHEN service NOT IN ({_EVEN}) THEN value END AS close
FROM sent WHERE event_type IN ('click', 'view')"""

_SESSION = f"""WITH {_TICKS}
SELECT symbol, ts, seq, price FROM ticks
WHERE isodow(ts) <= 5 AND CAST(ts AS TIME) BETWEEN TIME '09:29:00' AND TIME '16:00:00'"""

# The events lie in January, when New York is five hours behind UTC.
_SESSION_NEW_YORK = f"""WITH {_TICKS}
SELECT symbol, ts, seq, price FROM ticks WHERE isodow(ts - INTERVAL 5 HOUR) <= 5
  AND CAST(ts - INTERVAL 5 HOUR AS TIME) BETWEEN TIME '07:59:00' AND TIME '16:00:00'"""

_SIGNALS = f"""WITH {_TICKS}
SELECT symbol, ts, seq, close, CASE WHEN close < 100 THEN 'buy' ELSE 'sell' END AS signal
FROM ticks WHERE close < 100 OR close > 200"""

_RANGE = f"""WITH {_TICKS}
SELECT symbol, ts, seq, price FROM ticks
WHERE ts >= TIMESTAMP '2024-01-14 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'"""

_RANGE_PIVOT = f"""WITH {_BARS}
SELECT date AS _time, symbol, open, high, low, close, volume FROM bars
WHERE date >= TIMESTAMP '2024-01-08 00:00:00' AND date < TIMESTAMP '2024-01-15 00:00:00'"""

_LAST = f"WITH {_TICKS} SELECT * FROM ticks ORDER BY ts DESC, seq DESC LIMIT 60"

_LAST_PER_SYMBOL = f"""WITH {_TICKS}
SELECT * FROM ticks QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, seq DESC) <= 60"""

_HEAD = f"WITH {_TICKS} SELECT * FROM ticks ORDER BY ts, seq LIMIT 5"

_BUSINESS_DAYS = """WITH span AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
per_day AS (SELECT CAST(ts AS DATE) AS day, count(*) AS ticks FROM events GROUP BY 1)
SELECT day, coalesce(ticks, 0) AS ticks FROM days LEFT JOIN per_day USING (day) WHERE isodow(day) <= 5"""

_HISTOGRAM = f"""WITH {_TICKS}, long AS (
  SELECT 'price' AS column_name, price AS v FROM ticks UNION ALL SELECT 'volume', volume FROM ticks),
bounds AS (SELECT column_name, min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 15 AS step FROM long GROUP BY 1),
counted AS (
  SELECT column_name, least(CAST(floor((v - lo) / step) AS INTEGER) + 1, 15) AS bin, count(*) AS n
  FROM long JOIN bounds USING (column_name) GROUP BY ALL)
SELECT column_name, CAST(b.bin AS INTEGER) AS bin, round(lo + (b.bin - 1) * step, 6) AS bin_start,
       round(CASE WHEN b.bin = 15 THEN hi ELSE lo + b.bin * step END, 6) AS bin_end, coalesce(n, 0) AS n
FROM bounds CROSS JOIN range(1, 16) AS b(bin) LEFT JOIN counted c USING (column_name, bin)"""


def _profile(table: str, columns: dict[str, str | None]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, "
        + (f"'{kind}' AS data_type, " if kind else "")
        + f"count({name}) AS non_null, count(*) AS n_rows FROM {table}"
        for name, kind in columns.items()
    )


_EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")

_LINEITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}

_OHLCV = f"WITH {_BARS} SELECT * FROM bars"

_OHLCV_CLOSED = f"""WITH {_BARS}
SELECT * FROM bars WHERE date + INTERVAL 1 HOUR <= (
  SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM ticks)"""

_LATEST = f"""WITH {_TICKS}
SELECT * FROM ticks QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, seq DESC) = 1"""


def _screener(field: str, bars: str = _BARS) -> str:
    score = {
        "VOLUME": "volume",
        "TRADES": "CAST(trades AS DOUBLE)",
        "PERCENT_CHANGE_UP": "change",
        "PERCENT_CHANGE_DOWN": "change",
        "AVERAGE_PERCENT_VOLUME": """100 * volume / ((sum(volume) OVER (PARTITION BY symbol) - volume)
           / (count(*) OVER (PARTITION BY symbol) - 1))""",
    }[field]
    direction = "ASC" if field == "PERCENT_CHANGE_DOWN" else "DESC"
    return f"""WITH {bars}, metrics AS (
  SELECT symbol, date AS window_start, volume, trades,
         (close - open) / CASE WHEN open <> 0 THEN open END * 100 AS change FROM bars),
scored AS (SELECT symbol, window_start, {score} AS score FROM metrics),
ranked AS (
  SELECT window_start, CAST(row_number() OVER (
           PARTITION BY window_start ORDER BY score {direction}, symbol) AS INTEGER) AS rank, symbol, score
  FROM scored WHERE score IS NOT NULL)
SELECT window_start, rank, symbol, round(score, 6) AS score FROM ranked WHERE rank <= 3"""


# One row per command, key and field.
_COMMANDS = """SELECT event_id AS seq, CAST(user_id % 50 AS VARCHAR) AS service,
  CASE event_type WHEN 'signup' THEN 'SUBS' WHEN 'error' THEN 'UNSUBS' WHEN 'purchase' THEN 'VIEW'
  ELSE 'ADD' END AS command, CAST(k % 10 AS VARCHAR) AS key, CAST(k % 7 AS VARCHAR) AS field FROM events_k"""

_FEED_COMMANDS = f"""SELECT event_id AS seq, {_SERVICE} AS service,
  CASE WHEN k < 50 THEN 'ADD' WHEN k < 52 THEN 'SUBS' WHEN k < 90 THEN 'UNSUBS' ELSE 'VIEW' END AS command,
  event_type AS key,
  unnest(CASE k % 3 WHEN 0 THEN ['3'] WHEN 1 THEN ['8', '12'] ELSE ['12'] END) AS field FROM events_k"""


def _fold(commands: str) -> str:
    return f"""{_EVENTS}, log AS ({commands}),
resets AS (SELECT service, max(seq) AS s FROM log WHERE command = 'SUBS' GROUP BY 1),
removals AS (SELECT service, key, max(seq) AS u FROM log WHERE command = 'UNSUBS' GROUP BY ALL),
live AS (
  SELECT l.service, l.key, l.seq, l.field FROM log l
  LEFT JOIN resets r ON r.service = l.service
  LEFT JOIN removals x ON x.service = l.service AND x.key = l.key
  WHERE l.command IN ('ADD', 'SUBS') AND l.seq >= coalesce(r.s, -1) AND l.seq > coalesce(x.u, -1)),
born AS (SELECT service, key, min(seq) AS f FROM live GROUP BY ALL),
viewed AS (
  SELECT b.service, b.key, max(v.seq) AS v FROM born b
  JOIN log v ON v.service = b.service AND v.command = 'VIEW' AND v.seq > b.f GROUP BY ALL),
all_fields AS (
  SELECT l.service, l.key, l.field FROM live l LEFT JOIN viewed w USING (service, key)
  WHERE l.seq > coalesce(w.v, -1)
  UNION SELECT w.service, w.key, l.field FROM viewed w JOIN log l ON l.service = w.service AND l.seq = w.v),
state AS (SELECT service, key, list(field ORDER BY field) AS fields FROM all_fields GROUP BY ALL)"""


_SUBSCRIPTIONS = f"""WITH {_fold(_COMMANDS)}
SELECT service, key, array_to_string(fields, ',') AS fields FROM state"""

_SUBSCRIBED_FEED = f"""WITH {_fold(_FEED_COMMANDS)}, sent AS (
  SELECT {_SERVICE} AS service, * FROM events_k WHERE k > 1)
SELECT s.service, event_type AS symbol, date_trunc('millisecond', ts) AS date,
       CASE WHEN list_contains(fields, '3') THEN value END AS "lastPrice",
       CASE WHEN list_contains(fields, '8') THEN k END AS volume,
       CASE WHEN list_contains(fields, '12') THEN value END AS close
FROM sent s JOIN state t ON t.service = s.service AND t.key = s.event_type"""

_FIELD_LIST = "[" + ", ".join(f"'{f}'" for f in SORT_FIELDS) + "]"

_INSTRUMENTS = rf"""WITH {_EVENTS}, made AS (
  SELECT 'U' || user_id AS u, substr('{MONTH_CODES}', k % 12 + 1, 1) AS code, strftime(ts, '%y') AS yy,
         CASE WHEN k % 2 = 0 THEN 'C' ELSE 'P' END AS side, chr(CAST(65 + user_id % 26 AS INTEGER)) AS letter, *
  FROM events_k),
keys AS (
  SELECT DISTINCT CASE event_type
    WHEN 'click' THEN rpad(u, 6, ' ') || strftime(ts, '%y%m%d') || side || lpad(CAST(k * 1000 AS VARCHAR), 8, '0')
    WHEN 'view' THEN '/' || u || code || yy
    WHEN 'signup' THEN './' || u || code || yy || side || k
    WHEN 'purchase' THEN letter || letter || letter || '/USD'
    ELSE 'EQUITY_ALL_' || {_FIELD_LIST}[1 + k % 5] || '_30' END AS s FROM made),
patterns AS (SELECT *,
  '^(.{{6}})(\d{{6}})([CP])(\d{{5}})(\d{{3}})$' AS po,
  '^/([A-Z0-9]+)([{MONTH_CODES}])(\d{{2}})$' AS pf,
  '^\./([A-Z0-9]+)([{MONTH_CODES}])(\d{{2}})([CP])(\d+)$' AS pq,
  '^([A-Z]{{3}})/([A-Z]{{3}})$' AS px FROM keys),
parsed AS (
  SELECT 'option' AS class, rtrim(regexp_extract(s, po, 1)) AS underlying,
         strftime(strptime(regexp_extract(s, po, 2), '%y%m%d'), '%Y-%m-%d') AS expiry,
         CAST(regexp_extract(s, po, 4) || '.' || regexp_extract(s, po, 5) AS DOUBLE) AS strike
  FROM patterns WHERE regexp_matches(s, po)
  UNION ALL
  SELECT 'future', regexp_extract(s, pf, 1), '20' || regexp_extract(s, pf, 3) || '-'
         || lpad(CAST(instr('{MONTH_CODES}', regexp_extract(s, pf, 2)) AS VARCHAR), 2, '0'), NULL
  FROM patterns WHERE regexp_matches(s, pf)
  UNION ALL
  SELECT 'future_option', regexp_extract(s, pq, 1), '20' || regexp_extract(s, pq, 3) || '-'
         || lpad(CAST(instr('{MONTH_CODES}', regexp_extract(s, pq, 2)) AS VARCHAR), 2, '0'),
         CAST(regexp_extract(s, pq, 5) AS DOUBLE)
  FROM patterns WHERE regexp_matches(s, pq)
  UNION ALL
  SELECT 'forex', regexp_extract(s, px, 1), NULL, NULL FROM patterns WHERE regexp_matches(s, px)
  UNION ALL
  SELECT 'screener', 'EQUITY_ALL', NULL, NULL FROM patterns WHERE s LIKE 'EQUITY\_ALL\_%' ESCAPE '\')
SELECT class, underlying, expiry, count(*) AS instruments, min(strike) AS min_strike, max(strike) AS max_strike
FROM parsed GROUP BY ALL"""

_SPARSE = f"""{_EVENTS}, ticks AS (
  SELECT event_type AS symbol, ts, event_id AS seq, CASE WHEN k % 3 <> 0 THEN value END AS price,
         CASE WHEN k % 5 <> 0 THEN value END AS close, CASE WHEN k % 4 <> 0 THEN CAST(k AS DOUBLE) END AS volume
  FROM events_k)"""

_SPARSE_BARS = f"""{_SPARSE}, bars AS (
  SELECT symbol, date_trunc('hour', ts) AS date, arg_min(price, seq) FILTER (price IS NOT NULL) AS open,
         max(price) AS high, min(price) AS low, arg_max(price, seq) FILTER (price IS NOT NULL) AS close,
         sum(volume) AS volume, count(*) AS trades
  FROM ticks GROUP BY ALL)"""

_RSI_FLAT = f"""WITH RECURSIVE {_EVENTS}, parts AS (
  SELECT event_type AS symbol, ts, event_id AS seq, value,
         ntile(3) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS part FROM events_k),
ticks AS (SELECT symbol, ts, seq, CASE WHEN part = 2 THEN 50.0 ELSE value END AS close FROM parts),
moved AS (
  SELECT symbol, ts, seq, close, row_number() OVER w AS rn, close - lag(close) OVER w AS d
  FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY ts, seq)),
smoothed AS (
  SELECT symbol, rn, greatest(d, 0.0) AS g, greatest(-d, 0.0) AS l FROM moved WHERE rn = 2
  UNION ALL
  SELECT m.symbol, m.rn, greatest(m.d, 0.0) / 14 + s.g * 13 / 14, greatest(-m.d, 0.0) / 14 + s.l * 13 / 14
  FROM smoothed s JOIN moved m ON m.symbol = s.symbol AND m.rn = s.rn + 1)
SELECT m.symbol, m.ts, m.seq, m.close, round(CASE WHEN m.rn < 15 THEN NULL WHEN l > 0 THEN 100 - 100 / (1 + g / l)
       WHEN g > 0 THEN 100.0 END, 6) AS rsi
FROM moved m LEFT JOIN smoothed s ON s.symbol = m.symbol AND s.rn = m.rn"""

_EMA_NULLS = f"""WITH RECURSIVE {_SPARSE}, numbered AS (
  SELECT symbol, ts, seq, close, row_number() OVER (PARTITION BY symbol ORDER BY ts, seq) AS rn FROM ticks),
smoothed AS (
  SELECT symbol, rn, close AS ema FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.symbol, n.rn, CASE WHEN n.close IS NULL THEN s.ema WHEN s.ema IS NULL THEN n.close
         ELSE CAST(2 AS DOUBLE) / 27 * n.close + CAST(25 AS DOUBLE) / 27 * s.ema END
  FROM smoothed s JOIN numbered n ON n.symbol = s.symbol AND n.rn = s.rn + 1)
SELECT symbol, ts, seq, close, round(ema, 6) AS ema FROM numbered JOIN smoothed USING (symbol, rn)"""

_CUMULATIVE_NULLS = f"""WITH {_SPARSE}
SELECT symbol, ts, seq, price, CAST(sum(CAST(price AS DECIMAL(18, 2))) OVER (
  PARTITION BY symbol ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS DECIMAL(28, 2)) AS total FROM ticks"""

_TICK_JSON_FULL = f"""WITH {_SPARSE}
SELECT symbol, ts AS date, close AS open, close AS high, close AS low, close, volume, price AS "lastPrice",
       price AS "bidPrice", CAST(volume AS INTEGER) AS "bidSize", price + 1 AS "askPrice", CAST(volume AS INTEGER) AS "askSize"
FROM ticks WHERE close IS NOT NULL OR volume IS NOT NULL OR price IS NOT NULL"""

_PRICES = f"WITH {_SPARSE} SELECT symbol, price, volume, seq FROM ticks WHERE price IS NOT NULL"

_FAULTS = f"""{_EVENTS}, sent AS (
  SELECT *, k % 8 AS fault, k % 10 = 9 AS timeless, k = 50 AS nonsense, k = 51 AS nothing FROM events_k),
good AS (SELECT * FROM sent WHERE NOT nonsense AND NOT nothing),
items AS (
  SELECT 'B' AS symbol, CAST(event_id AS DOUBLE) AS price, CASE WHEN timeless THEN 'no_time' END AS reason FROM good
  UNION ALL
  SELECT CASE WHEN fault <> 1 THEN 'A' END, CASE fault WHEN 1 THEN 1.5 ELSE 2.5 END,
         CASE WHEN fault IN (0, 2) THEN 'bad_field' WHEN fault = 1 THEN 'no_symbol' WHEN timeless THEN 'no_time'
              WHEN fault = 3 THEN 'no_value' END FROM good)"""

_FEED_REJECTED = f"""WITH {_FAULTS}
SELECT reject_reason, count(*) AS n FROM (
  SELECT reason AS reject_reason FROM items WHERE reason IS NOT NULL
  UNION ALL SELECT CASE WHEN nonsense THEN 'malformed' ELSE 'empty' END FROM sent WHERE nonsense OR nothing)
GROUP BY 1"""

_FEED_ACCEPTED = f"""WITH {_FAULTS}
SELECT symbol, count(*) AS n, sum(price) AS total FROM items WHERE reason IS NULL GROUP BY 1"""

_BAR_CSV = f"WITH {_BARS} SELECT symbol, date, open, high, low, close, volume FROM bars"

_LINES_REJECTED = f"""WITH {_BARS}
SELECT CASE WHEN hour(date) = 7 THEN 'no_time' ELSE 'no_value' END AS reject_reason, count(*) AS n
FROM bars WHERE hour(date) IN (5, 7, 9) GROUP BY 1"""

_POINTS_TAGGED = f"""WITH {_BARS}
SELECT 'bars,stock=' || symbol || ',venue=v\\ ' || symbol || ' close=' || close || ' ' || epoch_ms(date) AS line FROM bars
UNION ALL SELECT symbol || '|v ' || symbol FROM bars"""

_LINES_STREAM = f"""WITH {_TICKS}
SELECT 'ticks,stock=' || symbol || ' price=' || price || ',volume=' || volume || ' ' || epoch_ms(date_trunc('millisecond', ts)) AS line FROM ticks"""

_DAYS_FROM = """WITH days AS (
  SELECT CAST(unnest(generate_series(DATE '2024-01-06', DATE '2024-02-28', INTERVAL 1 DAY)) AS DATE) AS day),
first AS (SELECT day FROM days WHERE isodow(day) <= 5 ORDER BY day LIMIT 20),
per_day AS (SELECT CAST(ts AS DATE) AS day, count(*) AS ticks FROM events GROUP BY 1)
SELECT day, coalesce(ticks, 0) AS ticks FROM first LEFT JOIN per_day USING (day)"""

_HISTOGRAM_NONFINITE = f"""WITH {_EVENTS}, bounds AS (
  SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 15 AS step FROM events_k WHERE k > 2),
counted AS (
  SELECT least(CAST(floor((value - lo) / step) AS INTEGER) + 1, 15) AS bin, count(*) AS n
  FROM events_k CROSS JOIN bounds WHERE k > 2 GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, coalesce(n, 0) AS n FROM range(1, 16) AS b(bin) LEFT JOIN counted USING (bin)
UNION ALL SELECT 0, count(*) FROM events_k WHERE k <= 2"""

_LATEST_PER_FIELD = f"""WITH {_SPARSE}
SELECT symbol, max(ts) AS ts, max(seq) AS seq, arg_max(price, seq) FILTER (price IS NOT NULL) AS price,
       arg_max(close, seq) FILTER (close IS NOT NULL) AS close, arg_max(volume, seq) FILTER (volume IS NOT NULL) AS volume
FROM ticks GROUP BY 1"""


_ODD = f"""{_EVENTS}, ticks AS (
  SELECT event_type AS symbol, ts, event_id AS seq,
         CASE WHEN k % 30 > 1 AND k % 15 <> 2 THEN value END AS close FROM events_k)"""

_EMA_NONFINITE = f"""WITH RECURSIVE {_ODD}, numbered AS (
  SELECT symbol, ts, seq, close, row_number() OVER (PARTITION BY symbol ORDER BY ts, seq) AS rn FROM ticks),
smoothed AS (
  SELECT symbol, rn, close AS ema FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.symbol, n.rn, CASE WHEN n.close IS NULL THEN s.ema WHEN s.ema IS NULL THEN n.close
         ELSE CAST(2 AS DOUBLE) / 13 * n.close + CAST(11 AS DOUBLE) / 13 * s.ema END
  FROM smoothed s JOIN numbered n ON n.symbol = s.symbol AND n.rn = s.rn + 1)
SELECT symbol, ts, seq, round(ema, 6) AS ema FROM numbered JOIN smoothed USING (symbol, rn)"""


def _rsi_wilder_ticks(ticks: str) -> str:
    return f"""WITH RECURSIVE {ticks}, moved AS (
  SELECT symbol, ts, seq, close, row_number() OVER w AS rn, close - lag(close) OVER w AS d
  FROM ticks WHERE close IS NOT NULL WINDOW w AS (PARTITION BY symbol ORDER BY ts, seq)),
smoothed AS (
  SELECT symbol, rn, greatest(d, 0.0) AS g, greatest(-d, 0.0) AS l FROM moved WHERE rn = 2
  UNION ALL
  SELECT m.symbol, m.rn, greatest(m.d, 0.0) / 14 + s.g * 13 / 14, greatest(-m.d, 0.0) / 14 + s.l * 13 / 14
  FROM smoothed s JOIN moved m ON m.symbol = s.symbol AND m.rn = s.rn + 1)
SELECT m.symbol, m.ts, m.seq, m.close, round(CASE WHEN m.rn < 15 THEN NULL WHEN l > 0 THEN 100 - 100 / (1 + g / l)
       WHEN g > 0 THEN 100.0 END, 6) AS rsi
FROM moved m LEFT JOIN smoothed s ON s.symbol = m.symbol AND s.rn = m.rn"""


def _sliding(where: str = "") -> str:
    return f"""WITH {_TICKS}, placed AS (
  SELECT t.*, time_bucket(INTERVAL 10 MINUTE, ts) - to_minutes(10 * i) AS date FROM ticks t, range(6) AS r(i)),
closes AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE AS mark FROM ticks)
SELECT symbol, date, arg_min(price, seq) AS open, max(price) AS high, min(price) AS low, arg_max(price, seq) AS close,
       sum(volume) AS volume, count(*) AS trades
FROM placed {where} GROUP BY symbol, date"""


def _sessions(where: str = "") -> str:
    return f"""WITH {_TICKS}, started AS (
  SELECT *, coalesce(ts - lag(ts) OVER w >= INTERVAL 30 MINUTE, true) AS s FROM ticks
  WINDOW w AS (PARTITION BY symbol ORDER BY ts, seq)),
numbered AS (SELECT *, count(*) FILTER (s) OVER (PARTITION BY symbol ORDER BY ts, seq) AS n FROM started),
found AS (
  SELECT symbol, min(ts) AS session_start, max(ts) AS session_end, count(*) AS ticks, arg_min(price, seq) AS open,
         arg_max(price, seq) AS close, sum(volume) AS volume FROM numbered GROUP BY symbol, n)
SELECT * FROM found {where}"""


_WATERMARK = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM ticks)"

_CLOSED_BARS = f"""{_BARS.replace("bars AS", "every_bar AS")}, bars AS (
  SELECT * FROM every_bar WHERE date + INTERVAL 1 HOUR <= {_WATERMARK})"""

_FEED_SPLIT = f"""WITH {_FAULTS}, units AS (
  SELECT reason, symbol FROM items
  UNION ALL SELECT CASE WHEN nonsense THEN 'malformed' ELSE 'empty' END, NULL FROM sent WHERE nonsense OR nothing),
counted AS (
  SELECT coalesce(reason, 'accepted') AS outcome, CASE WHEN reason IS NULL THEN symbol END AS symbol, count(*) AS n
  FROM units GROUP BY ALL)
SELECT *, CAST(sum(n) FILTER (outcome = 'accepted') OVER () AS BIGINT) AS all_accepted,
       CAST(sum(n) FILTER (outcome <> 'accepted') OVER () AS BIGINT) AS all_rejected FROM counted"""

# Each item replays the commands of its service up to its own time.
_AS_OF = f"""WITH {_EVENTS}, commands AS ({_FEED_COMMANDS}), log AS (
  SELECT c.*, e.ts AS at FROM commands c JOIN events e ON e.event_id = c.seq),
items AS (
  SELECT event_id AS id, {_SERVICE} AS service, event_type AS key, date_trunc('millisecond', ts) AS date, value, k
  FROM events_k WHERE k > 1),
resets AS (
  SELECT i.id, max(l.seq) AS s FROM items i JOIN log l ON l.service = i.service AND l.at <= i.date
  WHERE l.command = 'SUBS' GROUP BY 1),
removals AS (
  SELECT i.id, max(l.seq) AS u FROM items i JOIN log l ON l.service = i.service AND l.key = i.key AND l.at <= i.date
  WHERE l.command = 'UNSUBS' GROUP BY 1),
live AS (
  SELECT i.id, i.service, i.date, l.seq, l.field
  FROM items i JOIN log l ON l.service = i.service AND l.key = i.key AND l.at <= i.date
  LEFT JOIN resets r ON r.id = i.id LEFT JOIN removals x ON x.id = i.id
  WHERE l.command IN ('ADD', 'SUBS') AND l.seq >= coalesce(r.s, -1) AND l.seq > coalesce(x.u, -1)),
born AS (SELECT id, service, date, min(seq) AS f FROM live GROUP BY ALL),
viewed AS (
  SELECT b.id, max(l.seq) AS v FROM born b JOIN log l ON l.service = b.service AND l.at <= b.date
  WHERE l.command = 'VIEW' AND l.seq > b.f GROUP BY 1),
all_fields AS (
  SELECT l.id, l.field FROM live l LEFT JOIN viewed w USING (id) WHERE l.seq > coalesce(w.v, -1)
  UNION SELECT w.id, l.field FROM viewed w JOIN log l ON l.seq = w.v),
state AS (SELECT b.id, list(a.field) FILTER (a.field IS NOT NULL) AS fields FROM born b LEFT JOIN all_fields a USING (id) GROUP BY 1)
SELECT service, key AS symbol, date, CASE WHEN list_contains(fields, '3') THEN value END AS "lastPrice",
       CASE WHEN list_contains(fields, '8') THEN k END AS volume, CASE WHEN list_contains(fields, '12') THEN value END AS close
FROM items JOIN state USING (id)"""


ORACLE_SQL: dict[str, str] = {
    "sma_trend_counts": _sma_trend("SELECT symbol, trend, count(*) AS n FROM labelled GROUP BY ALL"),
    "sma_trend": _sma_trend("SELECT * FROM labelled"),
    "sma_trend_split": _sma_trend("SELECT * FROM labelled"),
    "sma_trend_stream": _sma_trend("SELECT * FROM labelled"),
    "sma_full_window": _SMA_FULL,
    "sma_stream": _SMA_FULL,
    "sma_keyed_stream": _SMA_FULL,
    "rsi_14": _RSI,
    "rsi_14_split": _RSI,
    "rsi_14_wilder": _RSI_WILDER,
    "rsi_14_wilder_flat": _RSI_FLAT,
    "rsi_14_wilder_flat_split": _RSI_FLAT,
    "ema_nulls": _EMA_NULLS,
    "ema_nulls_split": _EMA_NULLS,
    "macd": _MACD,
    "macd_split": _MACD_TICKS,
    "bollinger_15_2": _BOLLINGER,
    "price_diff": _PRICE_DIFF,
    "cumulative_value": _CUMULATIVE,
    "cumulative_value_split": _CUMULATIVE,
    "cumulative_nulls": _CUMULATIVE_NULLS,
    "cumulative_nulls_split": _CUMULATIVE_NULLS,
    "volume_direction": _VOLUME_DIRECTION,
    "studies_tail_60": _STUDIES_TAIL,
    "envelope_route_counts": _ROUTE_COUNTS,
    "envelope_flatten": _FLATTEN,
    "parse_bars": _PARSE_BARS,
    "rejected_counts": _REJECTED,
    "tick_json": _TICK_JSON,
    "tick_json_full": _TICK_JSON_FULL,
    "price_messages": _PRICES,
    "feed_rejected_counts": _FEED_REJECTED,
    "feed_accepted_counts": _FEED_ACCEPTED,
    "bar_csv": _BAR_CSV,
    "lines_rejected_counts": _LINES_REJECTED,
    "points_tagged": _POINTS_TAGGED,
    "line_protocol_stream": _LINES_STREAM,
    "line_protocol": _LINES,
    "points": _POINTS,
    "subscribe_filter": _SUBSCRIBE,
    "market_session": _SESSION,
    "market_session_new_york": _SESSION_NEW_YORK,
    "price_signals": _SIGNALS,
    "range_scan": _RANGE,
    "range_pivot": _RANGE_PIVOT,
    "last_60": _LAST,
    "last_60_per_symbol": _LAST_PER_SYMBOL,
    "head_5": _HEAD,
    "business_days": _BUSINESS_DAYS,
    "business_days_from": _DAYS_FROM,
    "histogram_nonfinite": _HISTOGRAM_NONFINITE,
    "histogram_15": _HISTOGRAM,
    "table_profile_events": _profile("events", dict.fromkeys(_EVENT_COLUMNS)),
    "table_profile_lineitem": _profile("lineitem", _LINEITEM_TYPES),
    "ohlcv_bars": _OHLCV,
    "ohlcv_bars_sparse": f"WITH {_SPARSE_BARS} SELECT * FROM bars",
    "ohlcv_bars_stream_all": _OHLCV,
    "ohlcv_bars_closed_stream": _OHLCV_CLOSED,
    "latest_quote": _LATEST,
    "latest_quote_per_field": _LATEST_PER_FIELD,
    "screener_percent_change_up_sparse": _screener("PERCENT_CHANGE_UP", _SPARSE_BARS),
    **{f"screener_{f.lower()}": _screener(f) for f in SORT_FIELDS},
    "subscription_fold": _SUBSCRIPTIONS,
    "subscribed_feed": _SUBSCRIBED_FEED,
    "instrument_chains": _INSTRUMENTS,
    "sma_late_stream": _sma_trend("SELECT * FROM labelled"),
    "ema_nonfinite": _EMA_NONFINITE,
    "ema_nonfinite_split": _EMA_NONFINITE,
    "rsi_wilder_nonfinite": _rsi_wilder_ticks(_ODD),
    "rsi_wilder_nonfinite_split": _rsi_wilder_ticks(_ODD),
    "rsi_wilder_stream": _rsi_wilder_ticks(_TICKS),
    "macd_stream": _MACD_TICKS,
    "cumulative_value_stream": _CUMULATIVE,
    "feed_split_counts": _FEED_SPLIT,
    "range_scan_compacted": _RANGE,
    "ohlcv_bars_sliding": _sliding(),
    "ohlcv_bars_sliding_stream": _sliding("JOIN closes ON date + INTERVAL 1 HOUR <= mark"),
    "tick_sessions": _sessions(),
    "tick_sessions_split": _sessions(),
    "tick_sessions_stream": _sessions(f"WHERE session_end + INTERVAL 30 MINUTE <= {_WATERMARK}"),
    "screener_average_percent_volume_stream": _screener("AVERAGE_PERCENT_VOLUME", _CLOSED_BARS),
    "subscription_fold_stream": _SUBSCRIPTIONS,
    "subscribed_feed_as_of": _AS_OF,
}

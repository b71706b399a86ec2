"""The SQL twin of each registered query that SQL can express, over the whole tables."""

from __future__ import annotations

DAY_MS = "86400000"
MART_COLUMNS = "symbol, trade_date, open, high, low, close, volume, quote_volume, trade_count"


def _bars(symbol: str, day: str, price: str, size: str, place: str, taker: str, source: str) -> str:
    value = f"{price} * {size}"
    return f"""
SELECT CAST({symbol} AS VARCHAR) AS symbol, CAST({day} AS DATE) AS trade_date,
  arg_min({price}, {place}) AS open, max({price}) AS high, min({price}) AS low,
  arg_max({price}, {place}) AS close,
  round(sum({size}), 2) AS volume, round(sum({value}), 4) AS quote_volume,
  count(*) AS trade_count,
  round(sum(CASE WHEN {taker} THEN {size} ELSE 0 END), 2) AS taker_buy_base_volume,
  round(sum(CASE WHEN {taker} THEN {value} ELSE 0 END), 4) AS taker_buy_quote_volume,
  date_diff('day', DATE '1970-01-01', CAST({day} AS DATE)) * {DAY_MS} AS open_time_ms
FROM {source} GROUP BY ALL"""


def _event_bars(symbol: str) -> str:
    return _bars(symbol, "ts", "value", "value", "(ts, event_id)", "event_id % 2 = 0", "events")


EVENT_BARS = _event_bars("event_type")
USER_BARS = _event_bars("user_id")
WHOLE_USER_BARS = f"""
SELECT * REPLACE (floor(open) AS open, floor(high) AS high, floor(low) AS low, floor(close) AS close)
FROM ({USER_BARS})"""
SUPPLIER_BARS = _bars(
    "l_suppkey",
    "l_shipdate",
    "l_extendedprice",
    "l_quantity",
    "(l_orderkey * 8 + l_linenumber, l_extendedprice)",
    "l_orderkey % 2 = 0",
    "lineitem",
)
TICKS = """
SELECT event_type AS symbol, event_id AS open_time_ms, value AS open,
  value + user_id % 7 AS high, value * 0.5 AS low, value AS close, user_id + 1.0 AS volume
FROM events"""

MART = """
SELECT *, stddev_samp(daily_return) OVER short AS volatility_7d,
  stddev_samp(daily_return) OVER long AS volatility_30d,
  avg(quote_volume) OVER long AS avg_quote_volume_30d
FROM (
  SELECT symbol, trade_date, open, high, low, close, volume, quote_volume, trade_count,
    close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY trade_date), 0) - 1
      AS daily_return
  FROM bars)
WINDOW short AS (PARTITION BY symbol ORDER BY trade_date ROWS 6 PRECEDING),
  long AS (PARTITION BY symbol ORDER BY trade_date ROWS 29 PRECEDING)"""

MARKETS = """
SELECT CAST(nation AS VARCHAR) AS coin_id, 'N' || nation AS symbol, 'nation ' || nation AS name,
  least AS current_price,
  CASE WHEN nation % 7 <> 3 THEN total END AS market_cap,
  CASE WHEN nation % 5 <> 1 THEN
    row_number() OVER (PARTITION BY month ORDER BY total DESC, nation)
      + CASE WHEN nation % 2 = 1 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END END AS market_cap_rank,
  most AS total_volume,
  round((most / least - 1) * 100, 6) AS price_change_percentage_24h,
  n AS circulating_supply, CAST(month AS VARCHAR) AS last_updated, 'usd' AS vs_currency,
  CAST(month AS TIMESTAMP) AS snapshot_date, CAST(month + 2 AS DATE) AS ingested_date
FROM (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, c_nationkey AS nation,
    round(sum(o_totalprice), 2) AS total, min(o_totalprice) AS least, max(o_totalprice) AS most,
    CAST(count(*) AS DOUBLE) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""

MARKETS_TWICE = """
SELECT * FROM markets
UNION ALL
SELECT * REPLACE (current_price * 2 AS current_price,
  CAST(ingested_date - 1 AS DATE) AS ingested_date) FROM markets"""

STG_MARKETS = """
SELECT coin_id, lower(symbol) AS symbol, name, current_price AS price_usd, market_cap,
  CAST(market_cap_rank AS INTEGER) AS market_cap_rank, total_volume AS volume_24h_usd,
  price_change_percentage_24h AS pct_change_24h, circulating_supply,
  CAST(snapshot_date AS DATE) AS snapshot_date, ingested_date
FROM markets_twice
QUALIFY row_number() OVER (
  PARTITION BY coin_id, CAST(snapshot_date AS DATE) ORDER BY ingested_date DESC) = 1"""

OVERVIEW = """
SELECT snapshot_date, round(sum(market_cap), 2) AS total_market_cap,
  round(sum(volume_24h_usd), 2) AS total_volume_24h, count(*) AS coins_tracked,
  round(sum(CASE WHEN coin_id = '0' THEN market_cap ELSE 0 END)
    / nullif(sum(market_cap), 0), 8) AS btc_dominance,
  round(sum(CASE WHEN market_cap_rank <= 10 THEN market_cap ELSE 0 END)
    / nullif(sum(market_cap), 0), 8) AS top10_share
FROM stg_markets WHERE market_cap IS NOT NULL GROUP BY snapshot_date"""

BATCH = """
SELECT CAST(CASE WHEN c_custkey % 50 = 7 THEN c_custkey - 7 ELSE c_custkey END AS VARCHAR)
    AS coin_id, c_custkey,
  CASE WHEN c_nationkey <> 11 THEN c_name END AS name, c_acctbal AS current_price,
  CASE WHEN c_nationkey % 7 <> 3 THEN c_acctbal * 10 END AS market_cap,
  CASE WHEN c_nationkey % 5 <> 1 THEN CAST(c_nationkey AS DOUBLE) END AS market_cap_rank,
  c_mktsegment AS symbol
FROM customer"""

FEATURES = """
SELECT *,
  coalesce((log_volume - avg(log_volume) OVER w) / nullif(stddev_samp(log_volume) OVER w, 0), 0)
    AS volume_z,
  coalesce((return_1d - avg(return_1d) OVER w) / nullif(stddev_samp(return_1d) OVER w, 0), 0)
    AS return_z
FROM (
  SELECT symbol, open_time_ms,
    coalesce(close / nullif(lag(close) OVER o, 0) - 1, 0) AS return_1d,
    ln(greatest(volume, 1e-12)) AS log_volume,
    coalesce((high - low) / nullif(close, 0), 0) AS hl_range_pct,
    coalesce((close - open) / nullif(open, 0), 0) AS close_open_pct
  FROM bars WINDOW o AS (PARTITION BY symbol ORDER BY open_time_ms))
WINDOW w AS (PARTITION BY symbol ORDER BY open_time_ms ROWS 6 PRECEDING)"""

RETURNS = """
SELECT symbol, open_time_ms, CAST(row_number() OVER o - 1 AS INTEGER) AS event_index, close, lag(close) OVER o AS pre_close,
  ln(greatest(close, 1e-12)) - lag(ln(greatest(close, 1e-12))) OVER o AS event_return
FROM bars WINDOW o AS (PARTITION BY symbol ORDER BY open_time_ms)"""


def _windows(pre: int, post: int) -> str:
    return f"""
SELECT symbol, open_time_ms, event_index, close AS event_close, pre_close, event_return,
  list(event_return) FILTER (event_return IS NOT NULL) OVER before AS pre_returns,
  CAST(count(event_return) OVER before AS INTEGER) AS n_pre,
  avg(event_return) OVER before AS pre_mean,
  CAST(count(event_return) OVER after AS INTEGER) AS n_post,
  avg(event_return) OVER after AS post_mean
FROM returns
WINDOW before AS (PARTITION BY symbol ORDER BY open_time_ms
    ROWS BETWEEN {pre} PRECEDING AND 1 PRECEDING),
  after AS (PARTITION BY symbol ORDER BY open_time_ms
    ROWS BETWEEN 1 FOLLOWING AND {post} FOLLOWING)"""


WINDOW_ROWS = """
SELECT symbol, open_time_ms, n_pre, n_post, n_pre = 10 AND n_post = 10 AS complete,
  round(event_return, 8) AS event_return, round(pre_mean, 8) AS pre_mean,
  round(post_mean, 8) AS post_mean
FROM windows"""

EXACT_NULL = """
SELECT symbol, open_time_ms, unnest(pre_returns) - pre_mean AS drawn FROM studied"""

DRAWN_NULL = """
SELECT symbol, open_time_ms, pre_returns[(mixed * 48271 + shift) % 2147483647 % n_pre + 1] - pre_mean
  AS drawn
FROM (
  SELECT *, (counter * counter + 48271) % 2147483647 AS mixed
  FROM (
    SELECT *, (CAST('0x' || substr(digest, 1, 15) AS BIGINT) % 2147483647 + draw * 40692)
        % 2147483647 AS counter,
      CAST('0x' || substr(digest, 16, 15) AS BIGINT) % 2147483647 AS shift
    FROM (SELECT *, md5('42|' || symbol || '|' || open_time_ms) AS digest FROM studied),
      (SELECT unnest(range(1, 501)) AS draw)))"""


def _study(pre: int, post: int) -> str:
    return f"""
SELECT s.symbol, s.open_time_ms, event_index, {pre} AS pre_window, {post} AS post_window, n_pre, n_post,
  round(pre_mean, 6) AS pre_mean_log_return, round(event_return, 6) AS event_log_return,
  round(post_mean, 6) AS post_mean_log_return,
  round(event_return - pre_mean, 6) AS diff_event_minus_pre,
  round(low, 6) AS null_p2_5, round(high, 6) AS null_p97_5, round(p, 4) AS p_event_vs_pre,
  event_close, pre_close,
  round((event_close / nullif(pre_close, 0) - 1) * 100, 4) AS abs_price_jump_pct
FROM studied s JOIN (
  SELECT symbol, open_time_ms, quantile_cont(drawn, 0.025) AS low,
    quantile_cont(drawn, 0.975) AS high,
    avg(CASE WHEN abs(drawn) >= abs(event_return - pre_mean) THEN 1.0 ELSE 0.0 END) AS p
  FROM nulls JOIN studied USING (symbol, open_time_ms) GROUP BY symbol, open_time_ms
) n ON s.symbol = n.symbol AND s.open_time_ms = n.open_time_ms"""


MIDDLE = """
SELECT symbol, open_time_ms FROM (
  SELECT symbol, open_time_ms,
    row_number() OVER (PARTITION BY symbol ORDER BY open_time_ms) AS place,
    count(*) OVER (PARTITION BY symbol) AS n
  FROM plain_bars)
WHERE place = n // 2 + 1"""

SHOCKED = """
SELECT * REPLACE (coalesce(target, close) AS close, greatest(high, target) AS high)
FROM (
  SELECT p.*, CASE WHEN m.symbol IS NOT NULL THEN
      lag(p.close) OVER (PARTITION BY p.symbol ORDER BY p.open_time_ms) * 1.12::DOUBLE END AS target
  FROM plain_bars p LEFT JOIN middle m
    ON p.symbol = m.symbol AND p.open_time_ms = m.open_time_ms)"""

PREDICTIONS = """
SELECT symbol, CAST(11 - from_end AS INTEGER) AS step, close AS actual, pred FROM (
  SELECT symbol, close, lag(close) OVER (PARTITION BY symbol ORDER BY open_time_ms) AS pred,
    row_number() OVER (PARTITION BY symbol ORDER BY open_time_ms DESC) AS from_end,
    count(*) OVER (PARTITION BY symbol) AS n
  FROM bars)
WHERE from_end <= 10 AND n > 15"""


def _with(body: str, **ctes: str) -> str:
    parts = ",\n".join(f"{name} AS ({text})" for name, text in ctes.items())
    return f"WITH RECURSIVE {parts}\n{body}"


def _on_markets(body: str, **ctes: str) -> str:
    return _with(
        body,
        markets=MARKETS,
        markets_twice=MARKETS_TWICE,
        stg_markets=STG_MARKETS,
        overview=OVERVIEW,
        **ctes,
    )


def _mart(body: str, bars: str = EVENT_BARS) -> str:
    return _with(body, bars=bars, mart=MART)


ALL_MART = f"""
SELECT {MART_COLUMNS}, round(daily_return, 8) AS daily_return,
  round(volatility_7d, 8) AS volatility_7d, round(volatility_30d, 8) AS volatility_30d,
  round(avg_quote_volume_30d + 1e-7, 4) AS avg_quote_volume_30d
FROM mart"""
ALL_FEATURES = """
SELECT symbol, open_time_ms, round(return_1d, 6) AS return_1d, round(log_volume, 6) AS log_volume,
  round(hl_range_pct, 6) AS hl_range_pct, round(close_open_pct, 6) AS close_open_pct,
  round(volume_z, 6) AS volume_z, round(return_z, 6) AS return_z
FROM features"""
ALL_RETURNS = """
SELECT symbol, open_time_ms, round(event_return, 8) AS log_return
FROM returns WHERE event_return IS NOT NULL"""
MERGED = """
SELECT * FROM mart WHERE trade_date >= DATE '2024-01-15'
UNION ALL
SELECT * REPLACE (close + 1.0::DOUBLE AS close) FROM mart WHERE trade_date < DATE '2024-01-15'"""
ALL_MERGED = f"""
SELECT {MART_COLUMNS.replace("close,", "round(close, 4) AS close,")},
  round(daily_return, 8) AS daily_return,
  round(volatility_7d, 8) AS volatility_7d, round(volatility_30d, 8) AS volatility_30d,
  round(avg_quote_volume_30d + 1e-7, 4) AS avg_quote_volume_30d
FROM merged"""
KLINE_COLUMNS = f"""symbol, open_time_ms, open, high, low, close, volume,
  open_time_ms + {DAY_MS} - 1 AS close_time_ms, quote_volume, trade_count,
  taker_buy_base_volume, taker_buy_quote_volume, '1d' AS interval,
  CAST(trade_date AS TIMESTAMP) AS open_time"""
WAREHOUSE_COUNTS = """
SELECT 'mart_daily_ohlcv' AS table_name, count(*) AS n FROM bars
UNION ALL SELECT 'mart_market_overview', count(*) FROM overview
UNION ALL SELECT 'stg_klines', count(*) FROM bars"""


def _results(rows: list[tuple[str, str, str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{model}' AS model, '{test}' AS test, '{column}' AS \"column\", "
        f"({failing}) AS failures"
        for model, test, column, failing in rows
    )


def _nulls(source: str, column: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE {column} IS NULL"


def _repeats(source: str, keys: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {keys} HAVING count(*) > 1)"


def _below(source: str, column: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE {column} <= 0"


def _violations(dataset: str, source: str, rules: list[tuple[str, str, str]], key: str) -> str:
    rows = [
        f"SELECT '{dataset}' AS dataset, '{rule}' AS rule, '{column}' AS \"column\", "
        f"CAST(count(*) FILTER ({broken}) AS BIGINT) AS n FROM {source}"
        for rule, column, broken in rules
    ]
    # The last key columns are the contract's; any before them delimit a batch.
    name = "coin_id" if dataset == "markets" else "symbol,open_time_ms"
    rows.append(
        f"SELECT '{dataset}', 'unique', '{name}', CAST(coalesce(sum(n), 0) AS BIGINT) FROM "
        f"(SELECT count(*) AS n FROM {source} GROUP BY {key} HAVING count(*) > 1)"
    )
    return "\nUNION ALL ".join(rows)


MARKET_RULES = [
    ("not_null", "coin_id", "coin_id IS NULL"),
    ("not_null", "symbol", "symbol IS NULL"),
    ("not_null", "name", "name IS NULL"),
    ("not_null", "current_price", "current_price IS NULL"),
    ("greater_than", "current_price", "current_price <= 0"),
    ("at_least", "market_cap", "market_cap < 0"),
    ("at_least", "market_cap_rank", "market_cap_rank < 1"),
    ("at_least", "total_volume", "abs(current_price) < 0"),
    ("at_least", "circulating_supply", "c_custkey < 0"),
    ("not_null", "last_updated", "false"),
    ("not_null", "vs_currency", "false"),
    ("not_null", "snapshot_date", "false"),
]
KLINE_PRICES = ("open", "high", "low", "close")
KLINE_AMOUNTS = (
    "volume",
    "quote_volume",
    "trade_count",
    "taker_buy_base_volume",
    "taker_buy_quote_volume",
)
KLINE_TIMES = ("open_time_ms", "close_time_ms")
KLINE_RULES = [
    *[
        ("not_null", name, f"{name} IS NULL")
        for name in (*KLINE_PRICES, *KLINE_AMOUNTS, *KLINE_TIMES, "open_time", "symbol")
    ],
    ("not_null", "interval", '"interval" IS NULL'),
    *[("greater_than", name, f"{name} <= 0") for name in (*KLINE_PRICES, *KLINE_TIMES)],
    *[("at_least", name, f"{name} < 0") for name in KLINE_AMOUNTS],
    ("ordered", "high>=low", "high < low"),
]
LINE_CANDLES = f"""
SELECT l_linenumber * {DAY_MS} AS open_time_ms, l_extendedprice AS open,
  l_extendedprice * (1 - l_tax) AS high, l_extendedprice * (1 - l_discount) AS low,
  l_extendedprice AS close, l_quantity AS volume,
  l_linenumber * {DAY_MS} + {DAY_MS} - 1 AS close_time_ms,
  l_extendedprice * l_quantity AS quote_volume, CAST(l_quantity AS BIGINT) AS trade_count,
  l_tax AS taker_buy_base_volume,
  CASE WHEN l_discount > 0 THEN l_discount END AS taker_buy_quote_volume,
  l_linenumber AS open_time, CAST(l_orderkey AS VARCHAR) AS symbol, '1d' AS "interval"
FROM lineitem"""
FIRST_CLOSE = " CASE ingestion WHEN 1 THEN open ELSE close END AS close,"
BATCHES = f"""
SELECT {KLINE_COLUMNS.replace(" close,", FIRST_CLOSE)}, trade_date + ingestion AS ingested_date
FROM bars, (SELECT unnest([1, 2]) AS ingestion)"""
REJECTED = """
SELECT c_custkey, coin_id,
  list_filter([
    CASE WHEN name IS NULL THEN 'not_null:name' END,
    CASE WHEN current_price <= 0 THEN 'greater_than:current_price' END,
    CASE WHEN market_cap < 0 THEN 'at_least:market_cap' END,
    CASE WHEN market_cap_rank < 1 THEN 'at_least:market_cap_rank' END,
    CASE WHEN count(*) OVER (PARTITION BY coin_id) > 1 THEN 'unique:coin_id' END],
    lambda rule: rule IS NOT NULL) AS failed
FROM batch"""

# The detail text names rule, column and count of each broken rule.
PROBES = """
SELECT 'markets_valid' AS name, 'markets' AS dataset, 'pass' AS expected,
  bool_and(current_price > 0 AND coalesce(market_cap >= 0, true)
    AND coalesce(market_cap_rank >= 1, true)) AS passed, 'validated' AS detail FROM markets
UNION ALL SELECT 'markets_reject_negative_price', 'markets', 'fail', count(*) > 0,
  'greater_than:current_price:1' FROM markets
UNION ALL SELECT 'markets_reject_duplicate_coin', 'markets', 'fail', count(*) > 1,
  'unique:coin_id:2' FROM markets
UNION ALL SELECT 'klines_valid', 'klines', 'pass', bool_and(low > 0 AND high >= low), 'validated'
  FROM bars
UNION ALL SELECT 'klines_reject_high_below_low', 'klines', 'fail', count(*) > 0,
  CASE WHEN min_by(low - 1, (symbol, open_time_ms)) <= 0
    THEN 'greater_than:high:1; ordered:high>=low:1' ELSE 'ordered:high>=low:1' END FROM bars"""
SUMMARY = """
SELECT count(*) AS total, CAST(count(*) FILTER (passed) AS BIGINT) AS passed,
  count(*) - count(*) FILTER (passed) AS failed,
  round(CAST(count(*) FILTER (passed) AS DOUBLE) / count(*), 4) AS pass_rate
FROM probes"""


def _describe(name: str) -> str:
    parts = {
        "mean": f"avg({name})",
        "std": f"stddev_samp({name})",
        "min": f"min({name})",
        "p25": f"quantile_cont({name}, 0.25)",
        "p50": f"quantile_cont({name}, 0.5)",
        "p75": f"quantile_cont({name}, 0.75)",
        "max": f"max({name})",
    }
    stats = ", ".join(f"round({text}, 8) AS {name}_{part}" for part, text in parts.items())
    return f"count({name}) AS {name}_count, {stats}"


DESCRIBED = f"SELECT symbol, {_describe('daily_return')}, {_describe('volatility_30d')} FROM mart GROUP BY symbol"


def _page(columns: str, where: str = "") -> str:
    return _mart(f"SELECT trade_date, {columns} FROM mart WHERE symbol = '7' {where}", USER_BARS)


def _last(name: str) -> str:
    return f"arg_max({name}, trade_date) FILTER ({name} IS NOT NULL)"


def _report_study(body: str) -> str:
    return _with(
        body,
        plain_bars=EVENT_BARS,
        middle=MIDDLE,
        bars=SHOCKED,
        returns=RETURNS,
        windows=_windows(12, 12),
        studied="SELECT * FROM windows SEMI JOIN middle USING (symbol, open_time_ms) "
        "WHERE n_pre = 12 AND n_post = 12",
        nulls=DRAWN_NULL,
        study=_study(12, 12),
    )


def _events(
    body: str, bars: str = EVENT_BARS, pre: int = 10, post: int = 10, null: str = EXACT_NULL
) -> str:
    return _with(
        body,
        bars=bars,
        returns=RETURNS,
        windows=_windows(pre, post),
        studied=f"SELECT * FROM windows WHERE n_pre = {pre} AND n_post = {post}",
        nulls=null,
    )


def _expected(n: str) -> str:
    return (
        f"CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + 0.5772156649015329) - 2 * ({n} - 1) / {n} "
        f"WHEN {n} = 2 THEN 1.0 ELSE 0.0 END"
    )


FEATURE_LIST = ("return_1d", "log_volume", "hl_range_pct", "close_open_pct", "volume_z", "return_z")
CIRCLE = 16**15
DEPTH = 8  # of trees on 256 rows


def _digits(text: str, place: int, size: int) -> str:
    return f"CAST('0x' || substr(md5({text}), {place}, {size}) AS BIGINT)"


def _forest(body: str) -> str:
    """The trees level by level, then every row's way down each of them."""
    every = range(1, len(FEATURE_LIST) + 1)
    ctes = {
        "bars": USER_BARS,
        "features": FEATURES,
        "f": f"SELECT r.*, close, volume, [{', '.join('r.' + c for c in FEATURE_LIST)}] AS x "
        f"FROM ({ALL_FEATURES}) r JOIN bars USING (symbol, open_time_ms)",
        "trees": f"SELECT t AS tree, {_digits("'42|tree|' || t", 1, 15)} AS start FROM range(100) r(t)",
        "drawn": f"""SELECT tree, 1 AS node, x FROM f, trees
QUALIFY row_number() OVER (PARTITION BY tree
  ORDER BY (({_digits("'42|' || symbol || '|' || open_time_ms", 1, 15)} - start) % {CIRCLE} + {CIRCLE})
    % {CIRCLE}, symbol, open_time_ms) <= 256""",
    }
    points = "drawn"
    for depth in range(DEPTH + 1):
        low = f"[{', '.join(f'min(x[{i}])' for i in every)}]"
        high = f"[{', '.join(f'max(x[{i}])' for i in every)}]"
        split = f"len(varying) > 0 AND {depth} < {DEPTH}"
        ctes[f"n{depth}"] = f"""
SELECT tree, node, {depth} AS depth, n, {split} AS split,
  CASE WHEN {split} THEN chosen END AS chosen,
  CASE WHEN {split} THEN low[chosen] + 0.999::DOUBLE * (share / 16.0::DOUBLE ** 13)
    * (high[chosen] - low[chosen]) END AS threshold
FROM (
  SELECT *, varying[{_digits("'42|' || tree || '|' || node", 1, 8)} % greatest(len(varying), 1) + 1] AS chosen,
    CAST({_digits("'42|' || tree || '|' || node", 9, 13)} AS DOUBLE) AS share
  FROM (
    SELECT *, [i FOR i IN {list(every)} IF low[i] < high[i]] AS varying
    FROM (SELECT tree, node, count(*) AS n, {low} AS low, {high} AS high FROM {points} GROUP BY tree, node)))"""
        if depth < DEPTH:
            ctes[f"p{depth + 1}"] = f"""
SELECT p.tree, 2 * p.node + CASE WHEN x[chosen] > threshold THEN 1 ELSE 0 END AS node, x
FROM {points} p JOIN n{depth} n ON p.tree = n.tree AND p.node = n.node WHERE split"""
            points = f"p{depth + 1}"
    ctes["nodes"] = " UNION ALL ".join(f"SELECT * FROM n{d}" for d in range(DEPTH + 1))
    way = "SELECT symbol, open_time_ms, x, tree, 1 AS node FROM f, trees"
    for depth in range(DEPTH):
        ctes[f"w{depth}"] = way
        way = f"""
SELECT symbol, open_time_ms, x, w.tree, CASE WHEN split
    THEN 2 * w.node + CASE WHEN x[chosen] > threshold THEN 1 ELSE 0 END ELSE w.node END AS node
FROM w{depth} w JOIN nodes n ON w.tree = n.tree AND w.node = n.node"""
    ctes["ends"] = way
    ctes["scores"] = f"""
SELECT symbol, open_time_ms,
  -pow(2, -avg(depth + {_expected('n::DOUBLE')}) / (SELECT {_expected('256::DOUBLE')})) AS score
FROM ends e JOIN nodes n ON e.tree = n.tree AND e.node = n.node GROUP BY ALL"""
    ctes["scored"] = """
SELECT symbol, open_time_ms, close, volume, return_1d, round(score - edge, 8) AS anomaly_score,
  score - edge < 0 AS is_anomaly
FROM scores JOIN f USING (symbol, open_time_ms), (SELECT quantile_cont(score, 0.05) AS edge FROM scores)"""
    ctes["top"] = "SELECT * FROM scored ORDER BY anomaly_score, symbol, open_time_ms LIMIT 5"
    ctes["summary"] = """
SELECT count(*) AS n_rows, count(*) FILTER (is_anomaly) AS n_anomalies,
  round(CAST(count(*) FILTER (is_anomaly) AS DOUBLE) / count(*), 4) AS anomaly_rate FROM scored"""
    return _with(body, **ctes)


def _forecast(body: str, **more: str) -> str:
    return _with(body, bars=USER_BARS, predictions=PREDICTIONS, **more)


UNIT = "(0.9::DOUBLE / 81)"


def _arima() -> dict[str, str]:
    """The lattice search: errors of every candidate row by row, the best for each step, its neighbours."""
    ctes = {
        "changes": """
SELECT symbol, n, t, w, close FROM (
  SELECT symbol, close, close - lag(close) OVER o AS w, row_number() OVER o - 1 AS t,
    count(*) OVER (PARTITION BY symbol) AS n
  FROM bars WINDOW o AS (PARTITION BY symbol ORDER BY open_time_ms)) WHERE n > 15 AND t > 0""",
        "c0": """
SELECT symbol, a, b FROM (SELECT DISTINCT symbol FROM changes),
  (SELECT unnest(range(-81, 82, 27)) AS a), (SELECT unnest(range(-81, 82, 27)) AS b)""",
    }
    for turn, spacing in enumerate((27, 9, 3, 1)):
        if turn:
            ctes[f"c{turn}"] = f"""
SELECT DISTINCT symbol, least(greatest(a + x * {spacing}, -88), 88) AS a,
  least(greatest(b + y * {spacing}, -88), 88) AS b
FROM b{turn - 1}, (SELECT unnest([-1, 0, 1]) AS x), (SELECT unnest([-1, 0, 1]) AS y)"""
        ctes[f"r{turn}"] = f"""
SELECT symbol, a, b, t, w, w AS e, w * w AS cost, n, close FROM c{turn} JOIN changes USING (symbol) WHERE t = 1
UNION ALL
SELECT symbol, a, b, t, w, e, cost + e * e AS cost, n, close FROM (
  SELECT r.symbol, r.a, r.b, c.t, c.w, c.w - a * {UNIT} * r.w - (-(b * {UNIT})) * r.e AS e, r.cost, c.n, c.close
  FROM r{turn} r JOIN changes c ON r.symbol = c.symbol AND c.t = r.t + 1)"""
        ctes[f"b{turn}"] = f"""
SELECT *, t - n + 12 AS step FROM r{turn} WHERE t BETWEEN n - 11 AND n - 2
QUALIFY row_number() OVER (PARTITION BY symbol, t
  ORDER BY round(ln(greatest(cost, 1e-300)), 9), abs(a) + abs(b), a, b) = 1"""
    ctes["arima"] = f"""
SELECT symbol, CAST(step AS INTEGER) AS step, p.actual,
  CASE WHEN cost > 0 THEN close + a * {UNIT} * w + (-(b * {UNIT})) * e ELSE close END AS pred,
  NOT cost > 0 AS fit_failed, cost > 0 AND abs(a) < 88 AND abs(b) < 88 AS converged
FROM b3 JOIN predictions p USING (symbol, step)"""
    return ctes


ARIMA = _arima()
METRICS = """
SELECT symbol, avg(abs(actual - pred)) AS mae, sqrt(avg((actual - pred) * (actual - pred))) AS rmse,
  coalesce(avg(CASE WHEN step > 1 THEN CASE WHEN sign(actual - last) = sign(pred - last) THEN 1.0 ELSE 0.0
    END END), 0) AS hit
FROM (SELECT *, lag(actual) OVER (PARTITION BY symbol ORDER BY step) AS last FROM {})
GROUP BY symbol"""
EVALUATED = """
SELECT symbol, n - 10 AS n_train, 10 AS n_holdout, '1,1,1' AS arima_order,
  round(v.mae, 4) AS naive_mae, round(v.rmse, 4) AS naive_rmse, round(v.hit, 4) AS naive_directional_accuracy,
  round(m.mae, 4) AS arima_mae, round(m.rmse, 4) AS arima_rmse, round(m.hit, 4) AS arima_directional_accuracy,
  round(m.mae, 4) < round(v.mae, 4) AS arima_beats_naive_mae
FROM (SELECT symbol, count(*) AS n FROM bars GROUP BY symbol)
  JOIN naive v USING (symbol) JOIN model m USING (symbol)"""
EVALUATION = {
    **ARIMA,
    "naive": METRICS.format("predictions"),
    "model": METRICS.format("arima"),
    "evaluated": EVALUATED,
}


EVERY = "SELECT * FROM "

ORACLES: dict[str, str] = {
    "parse_klines": _with(f"SELECT {KLINE_COLUMNS} FROM bars", bars=EVENT_BARS),
    "parse_markets": _with(
        "SELECT * EXCLUDE (ingested_date) FROM markets", markets=MARKETS
    ),
    "closed_candle_filter": _with(
        f"""SELECT symbol, open_time_ms, open_time_ms + {DAY_MS} - 1 AS close_time_ms, close,
  trade_count FROM bars WHERE open_time_ms + {DAY_MS} - 1 <= 1705708800000""",
        bars=USER_BARS,
    ),
    "ingest_all_symbols": _with(
        f"""SELECT symbol, count(*) AS rows FROM bars
WHERE open_time_ms + {DAY_MS} - 1 <= 978307200000 GROUP BY symbol""",
        bars=SUPPLIER_BARS,
    ),
    "ingest_all_markets": _with(
        """SELECT coin_id || '@' || strftime(snapshot_date, '%Y-%m') AS coin_id, current_price, market_cap,
  snapshot_date, DATE '2024-02-01' AS ingested_date FROM markets""",
        markets=MARKETS,
    ),
    "write_raw_partition": _with(
        """SELECT symbol, open_time_ms, open, high, low, close, volume,
  DATE '2024-02-01' AS ingested_date FROM bars""",
        bars=EVENT_BARS,
    ),
    "load_raw": _with(
        f"""SELECT symbol, open_time_ms, close, trade_count, DATE '2024-02-01' AS ingested_date
FROM bars
UNION ALL SELECT symbol, open_time_ms, close, trade_count, DATE '2024-01-20' FROM bars
WHERE open_time_ms + {DAY_MS} - 1 <= 1705708800000""",
        bars=EVENT_BARS,
    ),
    "load_raw_increment": _with(
        f"""SELECT symbol, open_time_ms, close, trade_count, DATE '2024-02-01' AS ingested_date
FROM bars
UNION ALL SELECT symbol, open_time_ms, close, trade_count, DATE '2024-01-20' FROM bars
WHERE open_time_ms + {DAY_MS} - 1 <= 1705708800000""",
        bars=USER_BARS,
    ),
    "snapshot_extent": _with(
        """SELECT count(*) AS rows, min(symbol) AS low_symbol, max(symbol) AS high_symbol,
  min(trade_date) AS low_trade_date, max(trade_date) AS high_trade_date FROM bars""",
        bars=USER_BARS,
    ),
    "raw_row_counts": _on_markets(
        f"""SELECT 'klines' AS dataset,
  count(*) + count(*) FILTER (open_time_ms + {DAY_MS} - 1 <= 1705708800000) AS n FROM bars
UNION ALL SELECT 'markets', count(*) FROM markets_twice""",
        bars=EVENT_BARS,
    ),
    "export_snapshot": _with(ALL_MERGED, bars=USER_BARS, mart=MART, merged=MERGED),
    "export_snapshot_counts": _on_markets(
        "SELECT 'mart_market_overview' AS mart, count(*) AS rows FROM overview"
    ),
    "report_json": _with(
        """SELECT count(DISTINCT symbol) AS symbols, max(trade_date) AS max_day,
  min(trade_date) AS min_day FROM bars""",
        bars=EVENT_BARS,
    ),
    "list_tables": _on_markets(WAREHOUSE_COUNTS, bars=EVENT_BARS),
    "stg_klines": _with(
        """SELECT symbol, '1d' AS interval, CAST(trade_date AS TIMESTAMP) AS open_time, trade_date,
  open, high, low, close, volume, quote_volume, trade_count,
  CAST(trade_date + 2 AS DATE) AS ingested_date FROM bars""",
        bars=USER_BARS,
    ),
    "stg_klines_late": _with(
        """SELECT symbol, '1d' AS interval, CAST(trade_date AS TIMESTAMP) AS open_time, trade_date,
  open, high, low, close, volume, quote_volume, trade_count,
  CAST(trade_date + 2 AS DATE) AS ingested_date FROM bars""",
        bars=USER_BARS,
    ),
    "latest_ingestion_wins": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  CAST(l_shipdate AS DATE) AS ingested_date
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY CAST(l_shipdate AS DATE) DESC, l_partkey, l_suppkey, l_extendedprice) = 1""",
    "stg_markets": _on_markets(EVERY + "stg_markets"),
    "daily_return": _mart(
        "SELECT symbol, trade_date, close, round(daily_return, 8) AS daily_return FROM mart",
        USER_BARS,
    ),
    "mart_daily_ohlcv": _mart(ALL_MART),
    "mart_daily_ohlcv_users": _mart(ALL_MART, USER_BARS),
    "mart_daily_ohlcv_suppliers": _mart(ALL_MART, SUPPLIER_BARS),
    "mart_daily_ohlcv_blocked": _mart(ALL_MART, USER_BARS),
    "market_overview": _on_markets(EVERY + "overview"),
    "merge_fresh_wins": _with(ALL_MERGED, bars=USER_BARS, mart=MART, merged=MERGED),
    "append_series": _with(
        """SELECT symbol, trade_date, round(close, 4) AS close, volume FROM bars
WHERE trade_date >= DATE '2024-01-15'
UNION ALL SELECT symbol, trade_date, round(close + 1.0::DOUBLE, 4), volume FROM bars
WHERE trade_date <= DATE '2024-01-20'""",
        bars=USER_BARS,
    ),
    "price_history": _mart("SELECT trade_date, symbol, close FROM mart", USER_BARS),
    "volatility_series": _mart(
        """SELECT trade_date, symbol, round(volatility_30d, 8) AS volatility_30d
FROM mart WHERE volatility_30d IS NOT NULL""",
        USER_BARS,
    ),
    "symbol_history": _page(
        """open, high, low, close, round(daily_return, 8) AS daily_return,
  round(volatility_7d, 8) AS volatility_7d, round(volatility_30d, 8) AS volatility_30d,
  quote_volume"""
    ),
    "symbol_latest": _mart(
        """SELECT close, round(daily_return, 8) AS daily_return,
  round(volatility_30d, 8) AS volatility_30d, quote_volume
FROM mart WHERE symbol = '7' ORDER BY trade_date DESC LIMIT 1""",
        USER_BARS,
    ),
    "symbol_price_series": _page("close"),
    "symbol_vol_series": _page(
        """round(volatility_7d, 8) AS volatility_7d,
  round(volatility_30d, 8) AS volatility_30d""",
        "AND (volatility_7d IS NOT NULL OR volatility_30d IS NOT NULL)",
    ),
    "symbol_returns": _page(
        "round(daily_return, 8) AS daily_return", "AND daily_return IS NOT NULL"
    ),
    "symbol_volumes": _page("quote_volume"),
    "ordered_marts": _mart(ALL_MART),
    "ordered_overview": _on_markets(EVERY + "overview ORDER BY snapshot_date"),
    "latest_overview": _on_markets(EVERY + "overview ORDER BY snapshot_date DESC LIMIT 1"),
    "latest_by_symbol": _mart(
        f"""SELECT symbol, '/symbols/' || symbol AS symbol_link, {_last('close')} AS last_close,
  round({_last('daily_return')}, 8) AS last_daily_return,
  round({_last('volatility_30d')}, 8) AS volatility_30d,
  round({_last('avg_quote_volume_30d')} + 1e-7, 4) AS avg_quote_volume_30d,
  max(trade_date) AS last_trade_date
FROM mart GROUP BY symbol""",
        USER_BARS,
    ),
    "describe_by_symbol": _mart(DESCRIBED),
    "describe_by_symbol_users": _mart(DESCRIBED, USER_BARS),
    "close_pivot": _mart(
        "SELECT trade_date, "
        + ", ".join(
            f"round(avg(close) FILTER (symbol = '{name}'), 8) AS {name}"
            for name in ("click", "error", "purchase", "signup", "view")
        )
        + " FROM mart GROUP BY trade_date"
    ),
    "top_n_by_market_cap": _with(
        """SELECT snapshot_date, coin_id, market_cap, market_cap_rank FROM markets
QUALIFY row_number() OVER (PARTITION BY snapshot_date
  ORDER BY market_cap DESC NULLS LAST, coin_id) <= 10""",
        markets=MARKETS,
    ),
    "lookback_last_n": _with(
        """SELECT symbol, trade_date, open, close, volume FROM bars
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time_ms DESC) <= 7""",
        bars=USER_BARS,
    ),
    "contract_markets": _with(
        _violations("markets", "batch", MARKET_RULES, "coin_id"), batch=BATCH
    ),
    "contract_klines": _with(
        _violations("klines", "candles", KLINE_RULES, "symbol, open_time_ms"),
        candles=LINE_CANDLES,
    ),
    "contract_klines_batches": _with(
        _violations("klines", "batches", KLINE_RULES, "ingested_date, symbol, open_time_ms"),
        bars=USER_BARS,
        batches=BATCHES,
    ),
    "contract_klines_zero_prices": _with(
        _violations("klines", "candles", KLINE_RULES, "symbol, open_time_ms"),
        bars=WHOLE_USER_BARS,
        candles=f"SELECT {KLINE_COLUMNS} FROM bars",
    ),
    "contract_rejects": _with(
        """SELECT c_custkey, coin_id, array_to_string(failed, '|') AS failed,
  failed[1] AS first_failed FROM rejected WHERE len(failed) > 0""",
        batch=BATCH,
        rejected=REJECTED,
    ),
    "test_not_null": _on_markets(
        _results(
            [
                ("stg_markets", "not_null", "coin_id", _nulls("stg_markets", "coin_id")),
                ("stg_markets", "not_null", "price_usd", _nulls("stg_markets", "price_usd")),
                ("stg_klines", "not_null", "symbol", _nulls("bars", "symbol")),
                ("stg_klines", "not_null", "close", _nulls("bars", "close")),
                ("mart_daily_ohlcv", "not_null", "close", _nulls("bars", "close")),
                (
                    "mart_market_overview",
                    "not_null",
                    "snapshot_date",
                    _nulls("overview", "snapshot_date"),
                ),
                (
                    "mart_market_overview",
                    "not_null",
                    "btc_dominance",
                    _nulls("overview", "btc_dominance"),
                ),
                ("customer_markets", "not_null", "name", _nulls("batch", "name")),
                ("customer_markets", "not_null", "market_cap", _nulls("batch", "market_cap")),
            ]
        ),
        bars=USER_BARS,
        batch=BATCH,
    ),
    "test_positive_value": _on_markets(
        _results(
            [
                ("stg_markets", "positive_value", "price_usd", _below("stg_markets", "price_usd")),
                ("mart_daily_ohlcv", "positive_value", "close", _below("bars", "close")),
                (
                    "customer_markets",
                    "positive_value",
                    "current_price",
                    _below("batch", "current_price"),
                ),
            ]
        ),
        bars=USER_BARS,
        batch=BATCH,
    ),
    "test_unique_combination": _on_markets(
        _results(
            [
                (
                    "lineitem",
                    "unique_combination",
                    "l_orderkey,l_linenumber",
                    _repeats("lineitem", "l_orderkey, l_linenumber"),
                ),
                (
                    "stg_markets",
                    "unique_combination",
                    "coin_id,snapshot_date",
                    _repeats("stg_markets", "coin_id, snapshot_date"),
                ),
                (
                    "mart_daily_ohlcv",
                    "unique_combination",
                    "symbol,trade_date",
                    _repeats("bars", "symbol, trade_date"),
                ),
            ]
        ),
        bars=USER_BARS,
    ),
    "test_unique_increment": """
SELECT l_orderkey, l_linenumber, CAST(2 AS BIGINT) AS n FROM lineitem
WHERE l_orderkey % 10 = 0 GROUP BY l_orderkey, l_linenumber
HAVING min(date_trunc('month', l_shipdate)) < DATE '2001-01-01'""",
    "test_unique": _on_markets(
        _results(
            [
                (
                    "mart_market_overview",
                    "unique",
                    "snapshot_date",
                    _repeats("overview", "snapshot_date"),
                ),
                ("customer_markets", "unique", "coin_id", _repeats("batch", "coin_id")),
            ]
        ),
        batch=BATCH,
    ),
    "data_tests": _on_markets(
        _results(
            [
                ("stg_klines", "not_null", "symbol", _nulls("bars", "symbol")),
                ("stg_klines", "not_null", "close", _nulls("bars", "close")),
                ("stg_klines", "positive_value", "close", _below("bars", "close")),
                (
                    "stg_klines",
                    "unique_combination",
                    "symbol,open_time",
                    _repeats("bars", "symbol, open_time_ms"),
                ),
                ("stg_markets", "not_null", "coin_id", _nulls("stg_markets", "coin_id")),
                ("stg_markets", "not_null", "price_usd", _nulls("stg_markets", "price_usd")),
                ("stg_markets", "positive_value", "price_usd", _below("stg_markets", "price_usd")),
                (
                    "stg_markets",
                    "unique_combination",
                    "coin_id,snapshot_date",
                    _repeats("stg_markets", "coin_id, snapshot_date"),
                ),
                ("mart_daily_ohlcv", "not_null", "close", _nulls("bars", "close")),
                ("mart_daily_ohlcv", "positive_value", "close", _below("bars", "close")),
                (
                    "mart_daily_ohlcv",
                    "unique_combination",
                    "symbol,trade_date",
                    _repeats("bars", "symbol, trade_date"),
                ),
                (
                    "mart_market_overview",
                    "not_null",
                    "snapshot_date",
                    _nulls("overview", "snapshot_date"),
                ),
                # No snapshot holds a coin of the default dominant id, so its share is 0, not NULL.
                (
                    "mart_market_overview",
                    "not_null",
                    "btc_dominance",
                    _nulls("overview", "btc_dominance"),
                ),
                (
                    "mart_market_overview",
                    "unique",
                    "snapshot_date",
                    _repeats("overview", "snapshot_date"),
                ),
            ]
        ),
        bars=EVENT_BARS,
    ),
    "contract_probes": _with(
        "SELECT *, CASE WHEN detail = 'validated' THEN '' ELSE detail END AS broken FROM probes",
        markets=MARKETS,
        bars=SUPPLIER_BARS,
        probes=PROBES,
    ),
    "probe_summary": _with(SUMMARY, markets=MARKETS, bars=SUPPLIER_BARS, probes=PROBES),
    "warehouse_freshness": _with(
        """SELECT count(DISTINCT symbol) AS symbols, max(trade_date) AS max_day,
  min(trade_date) AS min_day FROM bars""",
        bars=USER_BARS,
    ),
    "warehouse_row_counts": _on_markets(WAREHOUSE_COUNTS, bars=EVENT_BARS),
    "qc_scorecard": _on_markets(
        """SELECT 5 AS probes, summary.*, true AS available,
  'mart_daily_ohlcv,mart_market_overview,stg_klines' AS tables, CAST(NULL AS VARCHAR) AS reason,
  (SELECT string_agg(table_name || '=' || n, ',' ORDER BY table_name) FROM counts) AS row_counts,
  (SELECT count(DISTINCT symbol) FROM event_bars) AS symbols,
  (SELECT max(trade_date) FROM event_bars) AS max_day,
  (SELECT min(trade_date) FROM event_bars) AS min_day,
  CAST(CASE WHEN failed > 0 THEN 1 ELSE 0 END AS BIGINT) AS caveats
FROM summary""",
        bars=SUPPLIER_BARS,
        event_bars=EVENT_BARS,
        probes=PROBES,
        summary=SUMMARY,
        counts=WAREHOUSE_COUNTS.replace("FROM bars", "FROM event_bars"),
    ),
    "ohlcv_features": _with(ALL_FEATURES, bars=USER_BARS, features=FEATURES),
    "ohlcv_features_suppliers": _with(ALL_FEATURES, bars=SUPPLIER_BARS, features=FEATURES),
    "ohlcv_features_ticks": _with(ALL_FEATURES, bars=TICKS, features=FEATURES),
    "log_returns": _with(ALL_RETURNS, bars=USER_BARS, returns=RETURNS),
    "log_returns_ticks": _with(ALL_RETURNS, bars=TICKS, returns=RETURNS),
    "inject_shock": _with(
        """SELECT symbol, trade_date, round(high, 8) AS high, round(close, 8) AS close
FROM bars""",
        plain_bars=EVENT_BARS,
        middle=MIDDLE,
        bars=SHOCKED,
    ),
    "exact_quantiles": """
SELECT q, round(price, 6) AS price FROM (
  SELECT unnest([0.0::DOUBLE, 0.05::DOUBLE, 0.5::DOUBLE, 0.999::DOUBLE]) AS q,
    unnest(quantile_cont(l_extendedprice, [0.0, 0.05, 0.5, 0.999])) AS price FROM lineitem)""",
    "anomaly_fit": _forest(
        f"""SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node,
  CAST(CASE WHEN split THEN chosen - 1 ELSE 0 END AS INTEGER) AS feature,
  round(coalesce(threshold, 0), 6) AS threshold,
  CAST(CASE WHEN split THEN 2 * node ELSE node END AS INTEGER) AS "left",
  CAST(CASE WHEN split THEN 2 * node + 1 ELSE node END AS INTEGER) AS "right",
  round(CASE WHEN split THEN 0 ELSE depth + {_expected('n::DOUBLE')} END, 6) AS path FROM nodes"""
    ),
    "anomaly_score": _forest(
        "SELECT symbol, open_time_ms, close, anomaly_score, is_anomaly FROM scored"
    ),
    "top_anomalies": _forest(
        "SELECT open_time_ms, symbol, close, return_1d, volume, anomaly_score, is_anomaly FROM top"
    ),
    "anomaly_summary": _forest(EVERY + "summary"),
    "spike_flagged": _forest(
        """SELECT coalesce(bool_or(is_anomaly OR abs(return_1d) > 0.1), false) AS spike_flagged
FROM (SELECT * FROM top ORDER BY anomaly_score, symbol, open_time_ms LIMIT 1)"""
    ),
    "anomaly_report": _forest(
        f"""SELECT 'user bars' AS source, summary.*, 42 AS seed,
  '{",".join(FEATURE_LIST)}' AS feature_columns,
  (SELECT string_agg(symbol || '@' || open_time_ms, ',' ORDER BY anomaly_score, open_time_ms, symbol)
    FROM top) AS top_flags, 2 AS caveats FROM summary"""
    ),
    "naive_forecast": _forecast(EVERY + "predictions"),
    "forecast_metrics": _forecast(
        """SELECT symbol, 'naive' AS model, round(avg(abs(actual - pred)), 6) AS mae,
  round(sqrt(avg((actual - pred) * (actual - pred))), 6) AS rmse,
  round(coalesce(avg(CASE WHEN step > 1 THEN
    CASE WHEN sign(actual - pred) = 0 THEN 1.0 ELSE 0.0 END END), 0), 4) AS directional_accuracy,
  count(*) AS n_holdout, 0::BIGINT AS n_fit_failed
FROM predictions GROUP BY symbol"""
    ),
    "arima_forecast": _forecast(
        """SELECT symbol, 'arima' AS model, step, actual, round(pred, 4) AS pred, fit_failed, converged
FROM arima""",
        **ARIMA,
    ),
    "forecast_eval": _forecast(EVERY + "evaluated", **EVALUATION),
    "forecast_report": _forecast(
        """SELECT symbol, 'user bars' AS source, 2 AS limitations, n_train, naive_mae, arima_mae,
  arima_beats_naive_mae FROM evaluated""",
        **EVALUATION,
    ),
    "forecast_eligibility": _with(
        "SELECT symbol, count(*) AS n, count(*) > 15 AS eligible FROM bars GROUP BY symbol",
        bars=USER_BARS,
    ),
    "event_study_windows": _events(WINDOW_ROWS),
    "event_study_windows_ticks": _events(WINDOW_ROWS, TICKS),
    "event_study_rejects": _events(
        """SELECT symbol, open_time_ms, n_pre, n_post FROM windows
WHERE NOT (n_pre = 10 AND n_post = 10)"""
    ),
    "event_study_exact": _events(_study(10, 10)),
    "event_study_users": _events(_study(5, 5), USER_BARS, 5, 5),
    "event_study_bootstrap": _events(_study(10, 10), null=DRAWN_NULL),
    "event_study_report": _report_study(
        f"""SELECT symbol, DATE '1970-01-01' + CAST(open_time_ms // {DAY_MS} AS INTEGER)
    AS event_day,
  'event bars' AS source, 3 AS limitations, * EXCLUDE (symbol, open_time_ms) FROM study"""
    ),
}

"""One SQL text per registered query, plus the shared views they start from."""

from __future__ import annotations

# --- views -------------------------------------------------------------------------------------

RAW_PRICES = """
raw_prices AS (
  SELECT 'U' || user_id AS symbol, CAST(ts AS DATE) AS date,
         CASE WHEN event_type = 'click' THEN NULL ELSE value END AS open,
         CASE WHEN event_type = 'signup' THEN NULL ELSE value + 1 END AS high,
         value - 1 AS low,
         CASE WHEN event_type = 'error' THEN NULL ELSE value END AS close,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume,
         CASE WHEN event_type = 'view' THEN NULL ELSE value END AS adjusted_close,
         ts AS inserted_at, event_id
  FROM events)"""

LATEST_PRICES = RAW_PRICES + """,
latest_prices AS (
  SELECT * FROM raw_prices
  QUALIFY row_number() OVER (PARTITION BY symbol, date
                             ORDER BY inserted_at DESC, event_id DESC) = 1)"""

CLEAN_PRICES = LATEST_PRICES + """,
filled AS (
  SELECT symbol, date,
         last_value(open IGNORE NULLS) OVER w AS open,
         last_value(high IGNORE NULLS) OVER w AS high,
         last_value(low IGNORE NULLS) OVER w AS low,
         last_value(close IGNORE NULLS) OVER w AS close,
         last_value(volume IGNORE NULLS) OVER w AS volume,
         last_value(adjusted_close IGNORE NULLS) OVER w AS adjusted_close
  FROM latest_prices
  WINDOW w AS (PARTITION BY symbol ORDER BY date
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
clean_prices AS (SELECT * FROM filled WHERE close IS NOT NULL)"""

RAW_HEADLINES = """
raw_headlines AS (
  SELECT substr(sha256(CAST(doc_id AS VARCHAR)), 1, 16) AS headline_id,
         'U' || (doc_id % 15) AS symbol,
         strftime(TIMESTAMP '2024-01-01' + to_hours((doc_id * 7) % 720),
                  '%Y-%m-%dT%H:%M:%S') AS published_at,
         source, text AS headline,
         CASE WHEN doc_id % 4 <> 0 THEN 'https://news.example/' || doc_id END AS article_url,
         TIMESTAMP '2024-01-01' + to_hours((doc_id * 7) % 720) AS scraped_at,
         doc_id
  FROM documents)"""

STAGED_HEADLINES = RAW_HEADLINES + """,
repeated_headlines AS (
  SELECT * FROM raw_headlines
  UNION ALL
  SELECT * REPLACE (scraped_at + INTERVAL 1 DAY AS scraped_at) FROM raw_headlines),
staged_headlines AS (
  SELECT * FROM raw_headlines
  UNION ALL
  SELECT * REPLACE (scraped_at + INTERVAL 1 DAY AS scraped_at,
                    CASE WHEN headline_id LIKE 'f%' THEN '' ELSE headline END AS headline)
  FROM raw_headlines)"""


def clean(text: str) -> str:
    spaced = (
        f"regexp_replace(regexp_replace(lower({text}), '<[^>]+>', '', 'g'),"
        " '&[a-z]+;', ' ', 'g')"
    )
    white = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
    return f"trim(regexp_replace({spaced}, '{white}', ' ', 'g'))"


CLEAN_HEADLINES = f"""
clean_headlines AS (
  SELECT headline_id, symbol, published_at, {clean('source')} AS source,
         {clean('headline')} AS headline, article_url, scraped_at
  FROM repeated_headlines
  QUALIFY row_number() OVER (PARTITION BY headline_id ORDER BY scraped_at) = 1)"""

DAILY_OF = """
  SELECT symbol, CAST(scraped_at AS DATE) AS date,
         count(headline_id) AS headline_count,
         CAST(to_json(list(headline ORDER BY scraped_at, headline_id)) AS VARCHAR)
           AS headlines_json
  FROM {source} GROUP BY ALL"""

DAILY_BARS = """
utc_daily AS (
  SELECT 'U' || user_id AS symbol, date_trunc('day', ts)::TIMESTAMP AS datetime,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close,
         CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS volume
  FROM events GROUP BY ALL),
daily_bars AS (SELECT * EXCLUDE (datetime), CAST(datetime AS DATE) AS date FROM utc_daily),
bar_history AS (
  SELECT * FROM daily_bars
  WHERE date <= DATE '2024-01-20' AND symbol < 'U5'),
fetched_bars AS (
  SELECT *, 0 AS arrival FROM daily_bars
  UNION ALL BY NAME
  SELECT * REPLACE (close + 0.5 AS close), 1 AS arrival FROM daily_bars),
new_bars AS (
  SELECT f.symbol, f.date, f.open, f.high, f.low, f.close, f.volume
  FROM fetched_bars f
  LEFT JOIN (SELECT symbol, max(date) AS latest FROM bar_history GROUP BY symbol) h USING (symbol)
  WHERE h.latest IS NULL OR f.date > h.latest
  QUALIFY row_number() OVER (PARTITION BY f.symbol, f.date ORDER BY f.arrival DESC) = 1)"""

QUARTER_BARS = """
quarter_bars AS (
  SELECT 'U' || user_id AS symbol,
         time_bucket(INTERVAL 15 MINUTES, ts, TIMESTAMP '1970-01-01') AS datetime,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close,
         CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS volume
  FROM events GROUP BY ALL)"""

STOCKS = """
stocks AS (
  SELECT DISTINCT 'U' || user_id AS Symbol, 'Stock ' || user_id AS Stock_name,
         'Sector' AS Sector,
         CASE WHEN user_id % 10 <> 7 THEN 'stock-' || user_id END AS Groww_name,
         CASE WHEN user_id % 10 = 9 THEN ' ' ELSE 'NSE:U' || user_id END AS TradingView_name
  FROM events)"""

PREOPEN = """
items AS (
  SELECT l_suppkey, l_partkey,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
  FROM lineitem GROUP BY ALL),
priced AS (
  SELECT i.*, cents / 100 AS turnover, p_retailprice AS prev,
         ((2 * cents + quantity) // (2 * quantity)) / 100 AS last
  FROM items i JOIN part ON l_partkey = p_partkey),
moved AS (SELECT *, round(last - prev, 2) AS change FROM priced),
preopen AS (
  SELECT 'P' || l_partkey AS symbol, prev AS prev_close, last AS iep, change,
         change / prev * 100 AS pct_change, last AS final_price,
         quantity AS final_quantity,
         round(turnover / 1e7, 2) AS value_crores,
         CASE WHEN l_partkey % 2 = 1 THEN round(turnover * 100 / 1e7, 2) ELSE 0.0 END
           AS ffm_cap_crores,
         prev * 2 AS nm_52w_high, prev / 2 AS nm_52w_low,
         CAST(count_if(change > 0) OVER doc AS BIGINT) AS advances,
         CAST(count_if(change < 0) OVER doc AS BIGINT) AS declines,
         CASE WHEN l_suppkey % 7 = 0 THEN 'pending'
              ELSE strftime(DATE '2026-06-01' + CAST(l_suppkey % 28 AS INTEGER), '%d-%b-%Y')
                   || ' 09:07:55' END AS payload_time
  FROM moved
  WINDOW doc AS (PARTITION BY l_suppkey, l_partkey // 500))"""

HISTORY = RAW_HEADLINES + """,
fetched AS (
  SELECT * REPLACE (CASE WHEN headline_id LIKE 'a%' THEN '2 days ago' ELSE published_at END
                    AS published_at)
  FROM raw_headlines),
stored AS (SELECT * FROM fetched
           WHERE scraped_at <= TIMESTAMP '2024-01-20' AND symbol <> 'U3'),
cutoffs AS (
  SELECT symbol, max(try_strptime(published_at, '%Y-%m-%dT%H:%M:%S')) AS latest
  FROM stored GROUP BY symbol
  HAVING max(try_strptime(published_at, '%Y-%m-%dT%H:%M:%S')) IS NOT NULL),
newer AS (
  SELECT f.* FROM fetched f LEFT JOIN cutoffs c USING (symbol)
  WHERE c.latest IS NULL OR try_strptime(f.published_at, '%Y-%m-%dT%H:%M:%S') IS NULL
     OR try_strptime(f.published_at, '%Y-%m-%dT%H:%M:%S') > c.latest)"""

WINDOWS = """
spans AS (
  SELECT e.*, w AS window_start, w + INTERVAL 6 HOURS AS window_end
  FROM events e,
       unnest(generate_series(time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01')
                                - INTERVAL 5 HOURS,
                              time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01'),
                              INTERVAL 1 HOUR)) AS s(w))"""

LATENCY = WINDOWS + """,
latency AS (
  SELECT window_start, window_end, count(value) AS n, quantile_cont(value, 0.95) AS latency,
         quantile_cont(value, 0.95) > 150.0 AS breached
  FROM spans WHERE value IS NOT NULL GROUP BY ALL)"""

ERRORS = """
errors AS (
  SELECT window_start, window_end, count(*) AS n,
         count_if(event_type = 'error') AS errors,
         count_if(event_type = 'error') / 21600 AS errors_per_second,
         count_if(event_type = 'error') / count(*) AS error_share,
         count_if(event_type = 'error') / 21600 > 0.00085 AS breached
  FROM spans GROUP BY ALL)"""

DRIFT_EDGES = """
base AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-16' AND value IS NOT NULL),
curr AS (SELECT value FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND value IS NOT NULL)"""


def uniform(salt: str, seed: int = 7) -> str:
    key = f"symbol || '|' || strftime(date, '%Y-%m-%d') || '|{seed}|{salt}'"
    return f"(CAST('0x' || substr(sha256({key}), 1, 8) AS BIGINT) / 4294967296.0)"


def last_run(name: str, source: str) -> str:
    return f"""
  SELECT '{name}' AS alert, min(window_end) AS pending_from, max(window_end) AS last_breach,
         count(*) AS evaluations,
         CAST(epoch(max(window_end)) - epoch(min(window_end)) AS BIGINT) AS held_seconds,
         epoch(max(window_end)) - epoch(min(window_end)) >= 10800 AS fired
  FROM (SELECT window_end,
               epoch(window_end) - 3600 * row_number() OVER (ORDER BY window_end) AS run
        FROM {source} WHERE breached)
  GROUP BY run"""


def violations(contract: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    parts = [
        f"SELECT '{contract}' AS contract, '{rule}' AS rule, '{name}' AS field,"
        f" CAST(({count}) AS BIGINT) AS violations"
        for rule, name, count in rules
    ]
    return "\nUNION ALL ".join(parts).replace("{source}", source)


def broken(test: str) -> str:
    return "SELECT count(*) FROM {source} WHERE " + test


PRICE_RULES = [
    ("schema", "missing", "0"), ("schema", "wrong_type", "0"),
    ("not_null", "symbol", broken("symbol IS NULL")),
    ("not_null", "date", broken("date IS NULL")),
    ("max_length", "symbol", broken("length(symbol) > 128")),
    ("unique", "symbol,date",
     "SELECT count(*) - count(DISTINCT (symbol, date)) FROM {source}"),
]
HEADLINE_RULES = [
    ("schema", "missing", "1"), ("schema", "wrong_type", "0"),
    ("not_null", "headline_id", broken("headline_id IS NULL")),
    ("not_null", "symbol", broken("symbol IS NULL")),
    ("not_null", "headline", broken("headline IS NULL")),
    ("non_blank", "headline", broken("trim(headline) = ''")),
    ("max_length", "headline_id", broken("length(headline_id) > 64")),
    ("max_length", "symbol", broken("length(symbol) > 128")),
    ("max_length", "published_at", broken("length(published_at) > 128")),
    ("max_length", "source", broken("length(source) > 256")),
    ("unique", "headline_id",
     "SELECT count(*) - count(DISTINCT headline_id) FROM {source}"),
]

# --- statements --------------------------------------------------------------------------------

SQL: dict[str, str] = {}

SQL["feature_vectors"] = f"""
WITH {CLEAN_PRICES}, {STAGED_HEADLINES}, {CLEAN_HEADLINES},
daily AS ({DAILY_OF.format(source='clean_headlines')})
SELECT p.*, coalesce(headline_count, 0) AS headline_count,
       coalesce(headlines_json, '[]') AS headlines_json
FROM clean_prices p LEFT JOIN daily USING (symbol, date)"""

SQL["clean_prices"] = f"WITH {CLEAN_PRICES} SELECT * FROM clean_prices"

SQL["clean_headlines"] = (
    f"WITH {STAGED_HEADLINES}, {CLEAN_HEADLINES} SELECT * FROM clean_headlines"
)

SQL["dedupe_latest"] = f"WITH {LATEST_PRICES} SELECT * FROM latest_prices"

SQL["dedupe_first"] = f"""
WITH {STAGED_HEADLINES}
SELECT * EXCLUDE (doc_id) FROM repeated_headlines
QUALIFY row_number() OVER (PARTITION BY headline_id ORDER BY scraped_at) = 1"""

SQL["forward_fill"] = f"""
WITH {RAW_PRICES}
SELECT symbol, inserted_at, event_id,
       last_value(open IGNORE NULLS) OVER w AS open,
       last_value(high IGNORE NULLS) OVER w AS high,
       last_value(low IGNORE NULLS) OVER w AS low,
       last_value(close IGNORE NULLS) OVER w AS close,
       last_value(volume IGNORE NULLS) OVER w AS volume,
       last_value(adjusted_close IGNORE NULLS) OVER w AS adjusted_close
FROM raw_prices
WINDOW w AS (PARTITION BY symbol ORDER BY inserted_at
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

SQL["headline_daily_agg"] = f"WITH {RAW_HEADLINES} {DAILY_OF.format(source='raw_headlines')}"

SQL["headline_parts"] = f"""
WITH {RAW_HEADLINES},
slices AS (
  SELECT symbol, CAST(scraped_at AS DATE) AS date, scraped_at, substr(headline_id, 1, 3) AS slice,
         count(*) AS n
  FROM raw_headlines GROUP BY ALL),
parts AS (
  SELECT * EXCLUDE (n), CAST(floor(coalesce(sum(n) OVER (
           PARTITION BY symbol, date ORDER BY scraped_at, slice
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 2) AS BIGINT) AS part
  FROM slices)
SELECT p.symbol, p.date, p.part, count(headline_id) AS headline_count,
       CAST(to_json(list(headline ORDER BY r.scraped_at, headline_id)) AS VARCHAR)
         AS headlines_json
FROM raw_headlines r JOIN parts p
  ON r.symbol = p.symbol AND r.scraped_at = p.scraped_at AND substr(headline_id, 1, 3) = slice
GROUP BY ALL"""

SQL["clean_text_pages"] = f"SELECT page_id, {clean('html')} AS text FROM pages"

SQL["validate_headlines"] = f"""
WITH {STAGED_HEADLINES}
SELECT headline_id, symbol, published_at, source, headline, article_url,
       strftime(scraped_at, '%Y-%m-%dT%H:%M:%S') AS scraped_at
FROM staged_headlines
WHERE headline_id NOT LIKE '0%' AND headline_id NOT LIKE '1%' AND headline <> ''"""

SQL["validate_prices"] = f"""
WITH {RAW_PRICES}
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, open, high, low, close, volume,
       adjusted_close, strftime(inserted_at, '%Y-%m-%dT%H:%M:%S') AS fetched_at, event_id
FROM raw_prices WHERE close IS NOT NULL"""

SQL["rejected_counts"] = f"""
WITH {STAGED_HEADLINES}, {RAW_PRICES},
flags AS (
  SELECT headline_id LIKE '0%' AS broken, headline_id LIKE '1%' AS nan_id,
         headline = '' AS blank
  FROM staged_headlines),
counted AS (
  SELECT 'headlines' AS feed, 'headline_id' AS field, count_if(broken OR nan_id) AS rejected
  FROM flags
  UNION ALL SELECT 'headlines', 'symbol', count_if(broken) FROM flags
  UNION ALL SELECT 'headlines', 'headline', count_if(broken OR (blank AND NOT nan_id)) FROM flags
  UNION ALL SELECT 'prices', 'symbol', count_if(symbol IS NULL) FROM raw_prices
  UNION ALL SELECT 'prices', 'date', count_if(date IS NULL) FROM raw_prices
  UNION ALL SELECT 'prices', 'close', count_if(close IS NULL) FROM raw_prices)
SELECT feed, field, CAST(rejected AS BIGINT) AS rejected FROM counted WHERE rejected > 0"""

SQL["insert_ignore"] = f"""
WITH {STAGED_HEADLINES},
stored AS (SELECT * FROM raw_headlines WHERE scraped_at < TIMESTAMP '2024-01-16'),
incoming AS (
  SELECT * FROM repeated_headlines
  WHERE headline_id NOT IN (SELECT headline_id FROM stored)
  QUALIFY row_number() OVER (PARTITION BY headline_id ORDER BY scraped_at) = 1)
SELECT * EXCLUDE (doc_id) FROM stored
UNION ALL SELECT * EXCLUDE (doc_id) FROM incoming"""

SQL["upsert_latest"] = SQL["dedupe_latest"]

SQL["message_encode"] = f"""
WITH {RAW_PRICES}
SELECT event_id AS key, symbol, strftime(date, '%Y-%m-%d') AS date, open, high, low, close,
       volume, adjusted_close,
       open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL
         OR adjusted_close IS NULL AS has_null
FROM raw_prices"""

SQL["contract_violations"] = f"""
WITH {RAW_PRICES}, {STAGED_HEADLINES}
{violations('raw_prices', 'raw_prices', PRICE_RULES)}
UNION ALL {violations('raw_headlines', 'staged_headlines', HEADLINE_RULES)}"""

SQL["row_metrics"] = f"""
WITH {CLEAN_PRICES}
SELECT 'read' AS metric, count(*) AS row_count FROM raw_prices
UNION ALL SELECT 'written', count(*) FROM clean_prices"""

SQL["unmatched_headlines"] = f"""
WITH {CLEAN_PRICES}, {STAGED_HEADLINES}, {CLEAN_HEADLINES},
daily AS ({DAILY_OF.format(source='clean_headlines')})
SELECT d.* FROM daily d ANTI JOIN clean_prices p USING (symbol, date)"""

SQL["latest_per_symbol"] = f"""
WITH {HISTORY}
SELECT symbol, max(try_strptime(published_at, '%Y-%m-%dT%H:%M:%S')) AS latest
FROM fetched GROUP BY symbol
HAVING max(try_strptime(published_at, '%Y-%m-%dT%H:%M:%S')) IS NOT NULL ORDER BY symbol"""

SQL["latest_bar"] = (
    f"WITH {DAILY_BARS} SELECT symbol, max(date) AS latest FROM daily_bars GROUP BY symbol"
)

SQL["incremental_headlines"] = f"WITH {HISTORY} SELECT * EXCLUDE (doc_id) FROM newer"

SQL["appended_headlines"] = f"""
WITH {HISTORY}
SELECT headline_id, symbol, published_at FROM stored
UNION ALL SELECT headline_id, symbol, published_at FROM newer"""

SQL["incremental_bars"] = f"WITH {DAILY_BARS} SELECT * FROM new_bars"

SQL["new_rows_per_symbol"] = f"""
WITH {DAILY_BARS},
per_symbol AS (
  SELECT s.symbol, count(b.date) AS new_rows
  FROM (SELECT DISTINCT 'U' || user_id AS symbol FROM events) s
  LEFT JOIN new_bars b USING (symbol) GROUP BY s.symbol)
SELECT * FROM per_symbol
UNION ALL SELECT 'TOTAL', CAST(sum(new_rows) AS BIGINT) FROM per_symbol"""

SQL["backfill_plan"] = f"""
WITH {DAILY_BARS},
listed AS (
  SELECT symbol, latest
  FROM (SELECT DISTINCT 'U' || user_id AS symbol FROM events)
  LEFT JOIN (SELECT symbol, max(date) AS latest FROM bar_history GROUP BY symbol) USING (symbol)),
gaps AS (SELECT *, epoch(TIMESTAMP '2024-02-01 09:00:00') - epoch(latest) AS gap FROM listed)
SELECT 'daily' AS bar_interval, symbol, latest,
       CAST(CASE WHEN latest IS NULL THEN 10000
                 ELSE greatest(trunc(gap / 86400) + 5, 10) END AS BIGINT) AS bars
FROM gaps
UNION ALL
SELECT '15min', symbol, latest,
       CAST(CASE WHEN latest IS NULL THEN 10000
                 ELSE greatest(trunc(gap / 900) + 20, 10) END AS BIGINT)
FROM gaps"""

SQL["merge_bars"] = f"""
WITH {DAILY_BARS}
SELECT * FROM bar_history UNION ALL BY NAME SELECT * FROM new_bars ORDER BY symbol, date"""

SQL["merge_bars_summary"] = f"""
WITH {DAILY_BARS}, {QUARTER_BARS}
SELECT 'daily' AS bar_interval, count(*) AS row_count, count(DISTINCT symbol) AS symbol_count
FROM daily_bars
UNION ALL SELECT '15min', count(*), count(DISTINCT symbol) FROM quarter_bars"""

SQL["bars_csv_roundtrip"] = f"WITH {DAILY_BARS} SELECT * FROM daily_bars"

SQL["stock_dimension"] = f"""
WITH {STOCKS}
SELECT *, 'https://groww.in/stocks/' || Groww_name || '/market-news' AS news_url
FROM stocks WHERE trim(Groww_name) <> ''"""

SQL["resolve_symbol"] = f"""
WITH {DAILY_BARS}, {STOCKS}
SELECT s.Stock_name AS symbol, b.symbol AS source_symbol, b.date, b.close
FROM daily_bars b
LEFT JOIN (SELECT * FROM stocks WHERE trim(TradingView_name) <> '') s ON b.symbol = s.Symbol"""

SQL["parse_exchange_symbol"] = f"""
WITH {STOCKS}
SELECT Symbol,
       CASE WHEN TradingView_name LIKE '%:%' THEN split_part(TradingView_name, ':', 2)
            ELSE TradingView_name END AS ticker,
       CASE WHEN TradingView_name LIKE '%:%' THEN split_part(TradingView_name, ':', 1)
            ELSE 'NSE' END AS exchange,
       ' ' || Symbol || '/A ' AS plain_ticker, 'NSE' AS plain_exchange,
       '_' || Symbol || '_A_' AS safe_name
FROM stocks"""

SQL["preopen_flatten"] = f"WITH {PREOPEN} SELECT * FROM preopen"

SQL["preopen_snapshot"] = f"""
WITH {PREOPEN}
SELECT CASE WHEN payload_time = 'pending' THEN '20260701'
            ELSE strftime(strptime(payload_time, '%d-%b-%Y %H:%M:%S'), '%Y%m%d') END
         AS trade_date,
       symbol, pct_change, value_crores
FROM preopen"""

SQL["preopen_movers"] = f"""
WITH {PREOPEN}
SELECT symbol, pct_change, final_price, final_quantity FROM preopen
ORDER BY abs(pct_change) DESC NULLS LAST, symbol, final_price, final_quantity LIMIT 10"""

SQL["preopen_breadth"] = f"""
WITH {PREOPEN}
SELECT CASE WHEN l_suppkey % 7 = 0 THEN 'pending'
            ELSE strftime(DATE '2026-06-01' + CAST(l_suppkey % 28 AS INTEGER), '%d-%b-%Y')
                 || ' 09:07:55' END AS payload_time,
       CAST(count_if(change > 0) AS BIGINT) AS advances,
       CAST(count_if(change < 0) AS BIGINT) AS declines,
       CAST(count_if(change > 0) AS BIGINT) AS counted_advances,
       CAST(count_if(change < 0) AS BIGINT) AS counted_declines, count(*) AS items
FROM moved GROUP BY l_suppkey, l_partkey // 500"""

SQL["headline_ids"] = f"""
WITH {RAW_HEADLINES},
timed AS (
  SELECT *, strftime(scraped_at + INTERVAL 330 MINUTES, '%Y-%m-%dT%H:%M:%S') || '+05:30' AS iso
  FROM raw_headlines)
SELECT headline_id AS row_id, substr(sha256(coalesce(article_url, headline || iso)), 1, 16)
         AS headline_id,
       iso AS published_at, coalesce(article_url, '') AS article_url
FROM timed"""

SQL["parse_times"] = """
WITH texts AS (
  SELECT event_id, event_id % 5 AS kind,
         CASE event_id % 5
           WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000Z'
           WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
           WHEN 2 THEN strftime(ts, '%-d %b %Y, %I:%M %p') || ' IST'
           WHEN 3 THEN strftime(ts, '%-d %b %Y')
           ELSE '2 days ago' END AS text
  FROM events),
read AS (
  SELECT event_id,
         CASE kind
           WHEN 0 THEN try_strptime(text, '%Y-%m-%dT%H:%M:%S.000Z') + INTERVAL 330 MINUTES
           WHEN 1 THEN try_strptime(text, '%Y-%m-%dT%H:%M:%S')
           WHEN 2 THEN try_strptime(replace(text, ' IST', ''), '%d %b %Y, %I:%M %p')
           ELSE try_strptime(text, '%d %b %Y') END AS market_time
  FROM texts)
SELECT event_id, market_time,
       strftime(market_time, '%Y-%m-%dT%H:%M:%S') || '+05:30' AS iso
FROM read"""

SQL["localize_bars"] = f"""
WITH {QUARTER_BARS},
local_bars AS (
  SELECT symbol, datetime + INTERVAL 330 MINUTES AS datetime, round(open, 2) AS open,
         round(high, 2) AS high, round(low, 2) AS low, round(close, 2) AS close, volume
  FROM quarter_bars)
SELECT *, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS time_text, CAST(datetime AS DATE) AS day
FROM local_bars"""

SQL["localize_daily_bars"] = f"""
WITH {DAILY_BARS}
SELECT symbol, CAST(datetime + INTERVAL 330 MINUTES AS DATE) AS date, round(open, 2) AS open,
       round(high, 2) AS high, round(low, 2) AS low, round(close, 2) AS close, volume
FROM utc_daily"""

SQL["text_fields"] = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
longest AS (
  SELECT doc_id, line FROM lines WHERE length(line) > 20
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(line) DESC, pos) = 1)
SELECT d.doc_id, regexp_replace(trim(' ' || source || ' •· '), '[ •·]+$', '') AS source_label,
       coalesce(line, '') AS longest_line
FROM documents d LEFT JOIN longest USING (doc_id)"""

SQL["page_links"] = """
WITH links AS (
  SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS found FROM pages)
SELECT page_id, coalesce(list_filter(found,
         lambda x: starts_with(x, 'http') AND NOT contains(x, 'example.org'))[1], '') AS link
FROM links"""

SQL["news_cards"] = """
WITH titles AS (
  SELECT CAST(page_id AS VARCHAR) AS symbol,
         trim(regexp_replace(regexp_replace(regexp_extract(html, '<article><h1>(.*?)</h1>', 1),
                             '&quot;?', '"', 'g'), '&amp;?', '&', 'g')) AS headline
  FROM pages)
SELECT substr(sha256(headline), 1, 16) AS headline_id, symbol, '' AS published_at, '' AS source,
       headline, '' AS article_url, '2024-02-01T09:00:00+05:30' AS scraped_at
FROM titles WHERE headline <> ''"""

SQL["stream_headlines"] = f"""
WITH {RAW_HEADLINES}
SELECT headline_id, symbol, published_at, source, headline, article_url,
       strftime(scraped_at, '%Y-%m-%dT%H:%M:%S') AS scraped_at
FROM raw_headlines WHERE headline <> ''"""

SQL["stream_prices"] = f"""
WITH {RAW_PRICES}
SELECT symbol, date, open, high, low, close, volume, adjusted_close
FROM raw_prices WHERE close IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY symbol, date
                           ORDER BY inserted_at DESC, event_id DESC) = 1"""

SQL["stream_dedupe"] = "SELECT event_id, event_type, value FROM events"

SQL["stream_alert_error_rate"] = f"""
WITH {WINDOWS}, {ERRORS}
SELECT window_end, n, CAST(errors AS BIGINT) AS errors, breached FROM errors"""

SQL["stream_alert_firing"] = f"""
WITH {WINDOWS}, {ERRORS} {last_run('errors', 'errors')}"""

VALID_PRICES = CLEAN_PRICES.replace("FROM raw_prices\n", "FROM raw_prices WHERE close IS NOT NULL\n")

SQL["stream_features"] = f"""
WITH {VALID_PRICES}, {STAGED_HEADLINES}, {CLEAN_HEADLINES},
daily AS ({DAILY_OF.format(source="clean_headlines WHERE headline_id IN (SELECT headline_id "
                           "FROM raw_headlines WHERE headline <> '')")})
SELECT p.*, coalesce(headline_count, 0) AS headline_count,
       coalesce(headlines_json, '[]') AS headlines_json
FROM clean_prices p LEFT JOIN daily USING (symbol, date)"""

SQL["alert_latency_p95"] = f"""
WITH {LATENCY}
SELECT window_start, window_end, n, round(latency, 4) AS latency, breached FROM latency"""

SQL["alert_latency_histogram"] = f"""
WITH {WINDOWS},
bounds AS (
  SELECT * FROM (VALUES (0.0, 1.0), (1.0, 10.0), (10.0, 50.0), (50.0, 100.0), (100.0, 200.0),
                        (200.0, 400.0)) AS b(low, high)),
totals AS (SELECT window_start, window_end, count(*) AS n FROM spans GROUP BY ALL),
cums AS (
  SELECT window_start, window_end, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high,
         count_if(value <= low) AS under, count_if(value <= high) AS upto
  FROM spans, bounds GROUP BY ALL),
holding AS (
  SELECT c.*, n * 0.95::DOUBLE AS rank FROM cums c JOIN totals USING (window_start, window_end)
  WHERE upto >= n * 0.95::DOUBLE
  QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY high) = 1),
read AS (
  SELECT t.window_start, t.window_end, t.n,
         coalesce(low + (high - low) * (rank - CASE WHEN low = 0 THEN 0 ELSE under END)
                    / (upto - CASE WHEN low = 0 THEN 0 ELSE under END), 400.0) AS latency
  FROM totals t LEFT JOIN holding USING (window_start, window_end))
SELECT window_start, window_end, n, round(latency, 4) AS latency, latency > 150.0 AS breached
FROM read"""

SQL["alert_error_rate"] = f"""
WITH {WINDOWS}, {ERRORS}
SELECT window_start, window_end, n, CAST(errors AS BIGINT) AS errors,
       round(errors_per_second, 8) AS errors_per_second,
       round(error_share, 6) AS error_share, breached
FROM errors"""

SQL["alert_firing"] = f"""
WITH {LATENCY}, {ERRORS}
{last_run('latency', 'latency')}
UNION ALL {last_run('errors', 'errors')}"""

SQL["baseline_signals"] = f"""
WITH {CLEAN_PRICES}
SELECT symbol, date,
       ['high', 'low', 'flat'][CAST(floor({uniform('direction')} * 3) AS INTEGER) + 1] AS signal,
       round(0.3 + (0.9 - 0.3) * {uniform('confidence')}, 2) AS confidence,
       'baseline' AS model_version, TIMESTAMP '2024-02-01 09:00:00' AS created_at
FROM clean_prices"""

SQL["direction_labels"] = f"""
WITH {CLEAN_PRICES},
led AS (
  SELECT symbol, date, close,
         lead(open) OVER (PARTITION BY symbol ORDER BY date) AS next_open
  FROM clean_prices),
gapped AS (SELECT *, next_open / nullif(close, 0) - 1 AS gap FROM led)
SELECT symbol, date, close, next_open, round(gap, 6) AS gap,
       CASE WHEN gap > 0.001 THEN 'high' WHEN gap < -0.001 THEN 'low'
            WHEN gap IS NOT NULL THEN 'flat' END AS direction
FROM gapped"""

SQL["technical_features"] = f"""
WITH {CLEAN_PRICES},
lagged AS (
  SELECT symbol, date, close,
         close / nullif(lag(close, 1) OVER w, 0) - 1 AS return_1,
         close / nullif(lag(close, 2) OVER w, 0) - 1 AS return_2,
         close / nullif(lag(close, 5) OVER w, 0) - 1 AS return_5,
         avg(close) OVER (PARTITION BY symbol ORDER BY date
                          ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS sma_5,
         avg(close) OVER (PARTITION BY symbol ORDER BY date
                          ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS sma_20
  FROM clean_prices WINDOW w AS (PARTITION BY symbol ORDER BY date))
SELECT symbol, date, round(close, 6) AS close, round(return_1, 6) AS return_1,
       round(return_2, 6) AS return_2, round(return_5, 6) AS return_5,
       round(sma_5, 6) AS sma_5, round(sma_20, 6) AS sma_20,
       round(stddev_samp(return_1) OVER (PARTITION BY symbol ORDER BY date
             ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS volatility_20
FROM lagged"""

SQL["tfidf_terms"] = f"""
WITH terms AS (
  SELECT doc_id, unnest(string_split({clean('text')}, ' ')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term <> '' GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weighed AS (
  SELECT doc_id, term, tf, df,
         ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) AS idf
  FROM tf JOIN df USING (term))
SELECT doc_id, term, tf, df, round(idf, 6) AS idf, round(tf * idf, 6) AS tfidf FROM weighed"""

SQL["classification_metrics"] = """
WITH cells AS (SELECT toxic AS label, quality AS prediction, count(*) AS n FROM labels GROUP BY ALL),
classes AS (SELECT label AS class FROM cells UNION SELECT prediction FROM cells),
counted AS (
  SELECT class,
         (SELECT coalesce(sum(n), 0) FROM cells WHERE label = class) AS support,
         (SELECT coalesce(sum(n), 0) FROM cells WHERE prediction = class) AS predicted,
         (SELECT coalesce(sum(n), 0) FROM cells WHERE label = class AND prediction = class)
           AS correct
  FROM classes),
ratios AS (
  SELECT *, coalesce(correct / nullif(predicted, 0), 0.0) AS precision,
         coalesce(correct / nullif(support, 0), 0.0) AS recall
  FROM counted),
scored AS (
  SELECT CAST(class AS VARCHAR) AS class, support, predicted, correct, precision, recall,
         coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1
  FROM ratios),
both_levels AS (
  SELECT * FROM scored
  UNION ALL SELECT 'macro', sum(support), sum(predicted), sum(correct), avg(precision),
                   avg(recall), avg(f1) FROM scored)
SELECT class, CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted,
       CAST(correct AS BIGINT) AS correct, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1,
       round((SELECT sum(correct) / sum(support) FROM scored), 6) AS accuracy
FROM both_levels"""

SQL["confusion_matrix"] = """
SELECT toxic AS label, quality AS prediction, count(*) AS n FROM labels GROUP BY ALL"""

SQL["drift_psi"] = f"""
WITH {DRIFT_EDGES},
edges AS (
  SELECT unnest(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edge
  FROM base),
binned AS (
  SELECT (SELECT count(*) FROM edges WHERE edge <= v) AS bin, is_base
  FROM (SELECT value AS v, 1 AS is_base FROM base
        UNION ALL SELECT value, 0 FROM curr)),
counts AS (
  SELECT bin, sum(is_base) AS b, sum(1 - is_base) AS c FROM binned GROUP BY bin),
full_bins AS (
  SELECT CAST(range AS INTEGER) AS bin, CAST(coalesce(b, 0) AS BIGINT) AS baseline_count,
         CAST(coalesce(c, 0) AS BIGINT) AS current_count
  FROM range(10) LEFT JOIN counts ON range = bin),
shares AS (
  SELECT *, greatest(baseline_count / (SELECT count(*) FROM base), 1e-6) AS bs,
         greatest(current_count / (SELECT count(*) FROM curr), 1e-6) AS cs
  FROM full_bins)
SELECT bin, baseline_count, current_count, round(bs, 6) AS baseline_share,
       round(cs, 6) AS current_share, round((cs - bs) * ln(cs / bs), 6) AS psi
FROM shares"""

SQL["drift_ks"] = f"""
WITH {DRIFT_EDGES},
counts AS (
  SELECT v, sum(is_base) AS b, sum(1 - is_base) AS c
  FROM (SELECT value AS v, 1 AS is_base FROM base UNION ALL SELECT value, 0 FROM curr)
  GROUP BY v),
cums AS (
  SELECT sum(b) OVER (ORDER BY v) / (SELECT count(*) FROM base) AS fb,
         sum(c) OVER (ORDER BY v) / (SELECT count(*) FROM curr) AS fc
  FROM counts)
SELECT round(max(abs(fb - fc)), 8) AS ks,
       (SELECT count(*) FROM base) AS baseline_count,
       (SELECT count(*) FROM curr) AS current_count
FROM cums"""

SQL["stream_alert_latency"] = SQL["alert_latency_histogram"]

SQL["feature_vector_parts"] = f"""
WITH {CLEAN_PRICES},
parts AS ({SQL["headline_parts"]}),
counts AS (SELECT symbol, date, CAST(sum(headline_count) AS BIGINT) AS headline_count
           FROM parts GROUP BY ALL)
SELECT p.*, coalesce(c.headline_count, 0) AS headline_count, coalesce(h.part, 0) AS part,
       coalesce(h.headlines_json, '[]') AS headlines_json
FROM clean_prices p LEFT JOIN counts c USING (symbol, date) LEFT JOIN parts h USING (symbol, date)"""

SQL["history_lines"] = f"""
WITH {DAILY_BARS}
SELECT symbol, count(*) AS lines, symbol NOT LIKE '%7' AS accepted FROM daily_bars GROUP BY symbol"""

_SEEDED = {part: f"CASE WHEN known THEN {uniform(part, 11)} ELSE {uniform(part)} END" for part in ("direction", "confidence")}

SQL["batch_predict_seeded"] = f"""
WITH {CLEAN_PRICES},
requests AS (SELECT DISTINCT symbol, date FROM raw_prices)
SELECT symbol, strftime(date, '%Y-%m-%d') AS date,
       ['high', 'low', 'flat'][CAST(floor({_SEEDED['direction']} * 3) AS INTEGER) + 1] AS direction,
       round(0.3 + (0.9 - 0.3) * {_SEEDED['confidence']}, 2) AS confidence,
       CASE WHEN known THEN 'seeded-1' ELSE 'baseline' END AS model_version,
       '2024-02-01T09:00:00+05:30' AS timestamp
FROM requests LEFT JOIN (SELECT symbol, date, true AS known FROM clean_prices) USING (symbol, date)"""

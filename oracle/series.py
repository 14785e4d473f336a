"""SQL of the queries over ordered series."""

from __future__ import annotations

from oracle.statements import CLEAN_HEADLINES, CLEAN_PRICES, RAW_HEADLINES, RAW_PRICES, SQL, clean

SQL["asof_headlines"] = f"""
WITH {CLEAN_PRICES}, {RAW_HEADLINES},
dated AS (SELECT headline_id, symbol, CAST(scraped_at AS DATE) AS date FROM raw_headlines)
SELECT d.headline_id, d.symbol, d.date,
       CASE WHEN p.date - d.date <= 7 THEN p.date END AS matched_price_date,
       CASE WHEN p.date - d.date <= 7 THEN p.close END AS close
FROM dated d ASOF LEFT JOIN clean_prices p ON d.symbol = p.symbol AND d.date <= p.date"""

SQL["asof_last_quote"] = f"""
WITH {RAW_PRICES}, {RAW_HEADLINES},
quotes AS (
  SELECT symbol, inserted_at, close, volume FROM raw_prices
  QUALIFY row_number() OVER (PARTITION BY symbol, inserted_at
                             ORDER BY close DESC NULLS LAST, volume DESC NULLS LAST) = 1)
SELECT h.headline_id, h.symbol, h.scraped_at,
       CASE WHEN q.inserted_at >= h.scraped_at - INTERVAL 1 DAY THEN q.inserted_at END AS matched_quoted_at,
       CASE WHEN q.inserted_at >= h.scraped_at - INTERVAL 1 DAY THEN q.close END AS close,
       CASE WHEN q.inserted_at >= h.scraped_at - INTERVAL 1 DAY THEN q.volume END AS volume
FROM raw_headlines h ASOF LEFT JOIN quotes q ON h.symbol = q.symbol AND h.scraped_at >= q.inserted_at"""

_CARRIED = """
carried AS (
  SELECT h.symbol, h.headline_id, h.headline, h.scraped_at, h.news_date,
         CASE WHEN p.date - h.news_date <= 7 THEN p.date END AS date
  FROM (SELECT *, CAST(scraped_at AS DATE) AS news_date FROM {source}) h
  ASOF LEFT JOIN clean_prices p ON h.symbol = p.symbol AND h.news_date <= p.date)"""

SQL["feature_vectors_carried"] = f"""
WITH {CLEAN_PRICES}, {RAW_HEADLINES},
repeated_headlines AS (SELECT * FROM raw_headlines), {CLEAN_HEADLINES},
{_CARRIED.format(source="clean_headlines")},
daily AS (
  SELECT symbol, date, count(headline_id) AS headline_count,
         CAST(to_json(list(headline ORDER BY scraped_at, headline_id)) AS VARCHAR) AS headlines_json
  FROM carried WHERE date IS NOT NULL GROUP BY ALL)
SELECT p.*, coalesce(headline_count, 0) AS headline_count, coalesce(headlines_json, '[]') AS headlines_json
FROM clean_prices p LEFT JOIN daily USING (symbol, date)"""

SQL["headline_carry_audit"] = f"""
WITH {CLEAN_PRICES}, {RAW_HEADLINES}, {_CARRIED.format(source="raw_headlines")}
SELECT symbol, count(*) FILTER (WHERE date = news_date) AS same_day,
       count(*) FILTER (WHERE date <> news_date) AS carried,
       count(*) FILTER (WHERE date IS NULL) AS without_price
FROM carried GROUP BY symbol"""

SQL["recursive_indicators"] = f"""
WITH RECURSIVE {CLEAN_PRICES},
days AS (
  SELECT symbol, date, close, row_number() OVER s AS n, coalesce(close - lag(close) OVER s, 0) AS change
  FROM clean_prices WINDOW s AS (PARTITION BY symbol ORDER BY date)),
walk AS (
  SELECT symbol, n, date, close, close AS fast, close AS slow, CAST(0 AS DOUBLE) AS gain,
         CAST(0 AS DOUBLE) AS loss, CAST(0 AS DOUBLE) AS signal
  FROM days WHERE n = 1
  UNION ALL
  SELECT d.symbol, d.n, d.date, d.close, w.fast * 11 / 13 + d.close * 2 / 13, w.slow * 25 / 27 + d.close * 2 / 27,
         CASE WHEN w.n <= 14 THEN w.gain ELSE w.gain * 13 / 14 END + greatest(d.change, 0) / 14,
         CASE WHEN w.n <= 14 THEN w.loss ELSE w.loss * 13 / 14 END + greatest(-d.change, 0) / 14,
         w.signal * 0.8 + 0.2 * (w.fast * 11 / 13 + d.close * 2 / 13 - w.slow * 25 / 27 - d.close * 2 / 27)
  FROM walk w JOIN days d ON d.symbol = w.symbol AND d.n = w.n + 1)
SELECT symbol, date, close, round(fast, 6) AS ema_12, round(slow, 6) AS ema_26,
       CASE WHEN n > 14 THEN CASE WHEN gain + loss = 0 THEN 50.0
                                  ELSE round(100 * gain / (gain + loss), 6) END END AS rsi_14,
       round(fast - slow, 6) AS macd, round(signal, 6) AS macd_signal,
       round(fast - slow - signal, 6) AS macd_histogram
FROM walk"""

_SPANS = """
spans AS (
  SELECT g.*, w AS window_start, w + INTERVAL 6 HOURS AS window_end
  FROM grown g,
       unnest(generate_series(time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 5 HOURS,
                              time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01'),
                              INTERVAL 1 HOUR)) AS s(w))"""

_SO_FAR = "WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"

SQL["counter_error_rate"] = f"""
WITH samples AS (
  SELECT user_id, ts, count(*) FILTER (WHERE event_type = 'error') OVER w AS total FROM events {_SO_FAR}),
paired AS (SELECT *, lag(total) OVER (PARTITION BY user_id ORDER BY ts, total) AS before FROM samples),
grown AS (
  SELECT ts, CASE WHEN before IS NULL THEN 0 WHEN total < before THEN total ELSE total - before END AS increase
  FROM paired), {_SPANS}
SELECT window_start, window_end, CAST(sum(increase) AS BIGINT) AS increase,
       round(sum(increase) / 21600, 8) AS per_second, sum(increase) / 21600 > 0.00085 AS breached
FROM spans GROUP BY ALL"""

SQL["counter_latency"] = f"""
WITH bounds AS (SELECT unnest([1.0, 10.0, 50.0, 100.0, 200.0, 400.0, CAST('infinity' AS DOUBLE)]) AS le),
samples AS (
  SELECT user_id, le, ts, count(*) FILTER (WHERE value <= le) OVER w AS total
  FROM events, bounds
  WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE), le ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
paired AS (SELECT *, lag(total) OVER (PARTITION BY user_id, le ORDER BY ts, total) AS before FROM samples),
grown AS (
  SELECT le, ts, CASE WHEN before IS NULL THEN 0 WHEN total < before THEN total ELSE total - before END AS increase
  FROM paired), {_SPANS},
parts AS (SELECT window_start, window_end, le, CAST(sum(increase) AS BIGINT) AS own FROM spans GROUP BY ALL),
sums AS (
  SELECT window_start, window_end, le, max(own) OVER (PARTITION BY window_start, window_end ORDER BY le) AS c
  FROM parts),
ranked AS (
  SELECT window_start, window_end, le, c, max(c) OVER w AS n,
         coalesce(lag(le) OVER (w ORDER BY le), 0) AS lower, coalesce(lag(c) OVER (w ORDER BY le), 0) AS lower_count
  FROM sums WINDOW w AS (PARTITION BY window_start, window_end)),
hit AS (
  SELECT window_start, window_end, n, min(le) FILTER (WHERE c >= n * 0.95) AS le FROM ranked GROUP BY ALL),
read AS (
  SELECT h.window_start, h.window_end, h.n,
         CASE WHEN h.n > 0 THEN CASE WHEN h.le = 'infinity' THEN 400.0
           ELSE r.lower + (r.le - r.lower) * (h.n * 0.95 - r.lower_count) / (r.c - r.lower_count) END END AS latency
  FROM hit h JOIN ranked r ON h.window_start = r.window_start AND h.le = r.le)
SELECT window_start, window_end, n, round(latency, 4) AS latency, coalesce(latency > 150.0, false) AS breached
FROM read"""

SQL["stream_first_arrivals"] = SQL["stream_headlines"]
SQL["stream_bounded_headlines"] = SQL["stream_headlines"]

SQL["stream_alert_states"] = f"""
WITH grown AS (SELECT ts, event_type FROM events), {_SPANS},
closing AS (SELECT max(ts) - INTERVAL 1 HOUR AS closed FROM events),
evaluated AS (
  SELECT window_end, count(*) FILTER (WHERE event_type = 'error') / 21600 > 0.00085 AS breached
  FROM spans, closing WHERE window_end <= closed GROUP BY window_end),
runs AS (
  SELECT window_end, window_end - to_hours(row_number() OVER (ORDER BY window_end)) AS run
  FROM evaluated WHERE breached),
held AS (
  SELECT min(window_end) AS pending_from, max(window_end) AS last, count(*) AS n,
         max(window_end) < (SELECT max(window_end) FROM evaluated) AS over
  FROM runs GROUP BY run)
SELECT 'errors' AS alert, pending_from, last - pending_from >= INTERVAL 3 HOURS AS fired,
       CASE WHEN over THEN last + INTERVAL 1 HOUR END AS resolved_at, CASE WHEN over THEN n END AS evaluations
FROM held"""

_BAYES = f"""
terms AS (SELECT doc_id, unnest(string_split({clean('text')}, ' ')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term <> '' GROUP BY ALL),
known AS (SELECT doc_id, CAST(quality AS INTEGER) AS y, CAST(doc_id % 5 AS INTEGER) AS f
          FROM labels WHERE quality IN (0, 1)),
counts AS (SELECT term, f, y, sum(tf) AS n FROM tf JOIN known USING (doc_id) GROUP BY ALL),
folds AS (SELECT CAST(unnest([-1, 0, 1, 2, 3, 4]) AS INTEGER) AS fold),
model AS (
  SELECT fold, term, coalesce(sum(n) FILTER (WHERE y = 1 AND f <> fold), 0) AS p,
         coalesce(sum(n) FILTER (WHERE y = 0 AND f <> fold), 0) AS q
  FROM counts, folds GROUP BY fold, term HAVING p + q > 0),
sizes AS (SELECT fold, sum(p) AS ps, sum(q) AS qs, count(*) AS v FROM model GROUP BY fold),
priors AS (
  SELECT fold, ln((count(*) FILTER (WHERE y = 1 AND f <> fold) + 1)
                  / (count(*) FILTER (WHERE y = 0 AND f <> fold) + 1)) AS prior
  FROM known, folds GROUP BY fold),
asked AS (SELECT doc_id, y, coalesce(f, -1) AS fold FROM documents LEFT JOIN known USING (doc_id)),
sums AS (
  SELECT doc_id, sum(tf * (ln((p + 1) / (ps + v)) - ln((q + 1) / (qs + v)))) AS s
  FROM asked JOIN tf USING (doc_id) JOIN model USING (fold, term) JOIN sizes USING (fold) GROUP BY doc_id),
scored AS (
  SELECT doc_id, y AS label, fold, round(prior + coalesce(s, 0), 6) AS log_odds
  FROM asked JOIN priors USING (fold) LEFT JOIN sums USING (doc_id)),
bayes AS (
  SELECT *, 1 / (1 + exp(-log_odds)) AS probability, CAST(log_odds > 0 AS INTEGER) AS predicted FROM scored)"""

SQL["sentiment_bayes"] = f"""
WITH {_BAYES} SELECT * REPLACE (round(probability, 6) AS probability) FROM bayes"""

_CALIBRATION = """
bins AS (
  SELECT CAST(least(floor(probability * 10), 9) AS INTEGER) AS bin, count(*) AS n,
         avg(probability) AS mean_probability, avg(CAST(label AS DOUBLE)) AS positive_share
  FROM bayes WHERE label IS NOT NULL GROUP BY bin)"""

SQL["sentiment_calibration"] = f"""
WITH {_BAYES}, {_CALIBRATION}
SELECT bin, n, round(mean_probability, 6) AS mean_probability, round(positive_share, 6) AS positive_share FROM bins"""

SQL["sentiment_rank_quality"] = f"""
WITH {_BAYES}, {_CALIBRATION},
ranks AS (
  SELECT log_odds AS v, sum(label) AS pos, sum(1 - label) AS neg FROM bayes WHERE label IS NOT NULL GROUP BY v),
sides AS (
  SELECT *, coalesce(sum(neg) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         sum(pos) OVER (ORDER BY v DESC) AS hits, sum(pos + neg) OVER (ORDER BY v DESC) AS taken
  FROM ranks)
SELECT CAST(sum(pos + neg) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS positives,
       round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 6) AS auc,
       round(sum(pos * hits / taken) / sum(pos), 6) AS average_precision,
       round((SELECT sum(n * abs(mean_probability - positive_share)) / sum(n) FROM bins), 6) AS calibration_error,
       round((SELECT max(abs(mean_probability - positive_share)) FROM bins), 6) AS largest_gap
FROM sides"""


def _days(statement: str, end: str) -> str:
    """A drift statement over the raw events, with current rows up to ``end``, its window named."""
    if "WHERE ts >= TIMESTAMP '2024-01-16'" not in statement:
        raise ValueError("the drift views have changed")
    cut = statement.replace("WHERE ts >= TIMESTAMP '2024-01-16'",
                            f"WHERE ts >= TIMESTAMP '2024-01-16' AND ts < TIMESTAMP '{end}'")
    return f"SELECT *, '{end}' AS window_end FROM ({cut})"


for _name in ("psi", "ks"):
    SQL[f"drift_days_{_name}"] = " UNION ALL ".join(
        _days(SQL[f"drift_{_name}"], end) for end in ("2024-01-23", "2100-01-01"))

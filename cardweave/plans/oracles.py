"""The expected results in DuckDB SQL, computed from the tables without any XML.

The SQL states the feed's rules a second time, on typed columns.
"""

from __future__ import annotations

_FEED = """
f AS (
  SELECT o_orderkey AS k, o_custkey AS c,
    CAST(o_orderkey % 4 AS INTEGER) AS part,
    row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey) - 1 AS pos,
    (o_orderkey % 29 = 0 OR o_orderkey % 31 = 0 OR o_orderkey % 37 = 0 OR o_orderkey % 41 = 0) AS damaged,
    CASE o_orderkey % 7 WHEN 0 THEN 'TVN' WHEN 1 THEN 'TCN' WHEN 2 THEN 'ACN' WHEN 3 THEN 'TAR'
      WHEN 4 THEN 'TVN' ELSE 'UNKNOWN' END AS mt,
    CASE WHEN o_orderkey % 5 = 0 THEN 'OTHER' ELSE 'PTLFX' END AS rt,
    'TXN-' || o_orderkey AS txn,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '12'
      ELSE '4' || lpad(CAST(o_custkey AS VARCHAR), 15, '0') END AS pan,
    CASE WHEN o_orderkey % 19 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE
      CAST(CAST(round(o_totalprice * 100) AS BIGINT) // 100 AS VARCHAR) || '.' ||
      lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') END AS amt,
    CASE o_custkey % 3 WHEN 0 THEN 'NZD' WHEN 1 THEN 'AUD' ELSE 'USD' END AS cur,
    CASE o_orderstatus WHEN 'F' THEN '00' WHEN 'O' THEN '05' ELSE '91' END AS rc,
    o_orderdate + to_seconds(o_orderkey % 86400) AS moment,
    CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderdate + to_seconds(o_orderkey % 86400) END AS ts
  FROM orders
)"""

# Messages that are well formed, and those that are published.
_PARSED = ", m AS (SELECT * FROM f WHERE NOT damaged)"
_PUBLISHED = ", p AS (SELECT * FROM f WHERE NOT damaged AND k % 5 <> 0 AND k % 7 IN (0, 1, 2, 4))"

_VAULT = """, v AS (
  SELECT '4' || lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS pan, 'TOK-' || c_custkey AS token
  FROM customer WHERE c_custkey % 10 <> 0
)"""

# The text of each record, for the codec queries.
_TEXT = """, t0 AS (
  SELECT f.*, '<Data>'
    || CASE o_k7 WHEN 0 THEN '<MessageType>TVN</MessageType>' WHEN 1 THEN '<MessageType>TCN</MessageType>'
         WHEN 2 THEN '<MessageType>ACN</MessageType>' WHEN 3 THEN '<MessageType>TAR</MessageType>'
         WHEN 4 THEN '<MessageType>tvn </MessageType>' WHEN 5 THEN '<MessageType>XYZ</MessageType>' ELSE '' END
    || '<RecordType>' || CASE k % 5 WHEN 0 THEN 'OTHER' WHEN 1 THEN ' ptlfx ' ELSE 'PTLFX' END || '</RecordType>'
    || '<TransactionId>' || txn || '</TransactionId>'
    || CASE WHEN pan IS NULL THEN '' ELSE '<DigitalPan>' || pan || '</DigitalPan>' END
    || CASE WHEN k % 19 = 0 THEN '' WHEN k % 17 = 0 THEN '<Amount>N/A</Amount>'
         ELSE '<Amount>' || amt || '</Amount>' END
    || '<CurrencyCode>' || cur || '</CurrencyCode><ResponseCode>' || rc || '</ResponseCode><Timestamp>'
    || strftime(moment, '%Y-%m-%dT%H:%M:%S') || CASE WHEN k % 23 = 0 THEN 'Z' ELSE '' END || '</Timestamp>' AS body
  FROM (SELECT *, k % 7 AS o_k7 FROM f) f
), t AS (
  SELECT *, CASE WHEN k % 29 = 0 THEN body WHEN k % 31 = 0 THEN body || '</Data>junk' WHEN k % 37 = 0 THEN NULL
    WHEN k % 41 = 0 THEN '   ' ELSE body || '</Data>' END AS txt
  FROM t0
)"""

# First settlement with the customer vault and the failing saves.
_OUTCOME = _PUBLISHED + _VAULT + """, w AS (SELECT DISTINCT pan, token FROM v), o AS (
  SELECT f.*, w.token,
    CASE WHEN damaged THEN 'MALFORMED' WHEN k % 5 = 0 THEN 'NOT_PTLFX' WHEN k % 7 IN (3, 5, 6) THEN 'NOT_ACTIONABLE'
      WHEN w.token IS NULL THEN 'TOKENISE_FAILED' WHEN k % 43 = 0 THEN 'SAVE_FAILED' ELSE 'OK' END AS reason
  FROM f LEFT JOIN w ON f.pan = w.pan
), r AS (
  SELECT *, CASE WHEN reason = 'OK' THEN 'SUCCESS' WHEN reason IN ('TOKENISE_FAILED', 'SAVE_FAILED') THEN 'RETRY'
    ELSE 'SKIPPED' END AS result,
    CASE WHEN reason IN ('MALFORMED', 'NOT_PTLFX', 'NOT_ACTIONABLE') THEN 0 ELSE 1 END AS tries,
    CASE WHEN reason IN ('MALFORMED', 'NOT_PTLFX', 'NOT_ACTIONABLE') THEN NULL ELSE token END AS shown
  FROM o
)"""

_ID = 'part AS "partition", pos AS "offset"'
_ISO = """CASE WHEN date_part('second', ts) = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M')
    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END"""


def _with(ctes: str, query: str) -> str:
    return f"WITH {_FEED}{ctes}\n{query}"


def _final(rounds: str) -> str:
    """Last outcome when a record has been tried ``rounds`` times, an expression in k."""
    return _with(
        _OUTCOME
        + f""", z AS (SELECT *, {rounds} AS rounds,
            CASE WHEN k % 86 = 0 THEN 3 WHEN k % 43 = 0 THEN 2 ELSE 1 END AS needed FROM r)""",
        f"""SELECT {_ID},
          CASE WHEN tries = 0 THEN 'SKIPPED' WHEN token IS NULL OR needed > rounds THEN 'RETRY'
            ELSE 'SUCCESS' END AS result,
          CASE WHEN tries = 0 THEN reason WHEN token IS NULL THEN 'TOKENISE_FAILED'
            WHEN needed > rounds THEN 'SAVE_FAILED' ELSE 'OK' END AS reason,
          CAST(CASE WHEN tries = 0 THEN 0 WHEN token IS NULL THEN rounds ELSE least(needed, rounds) END AS INTEGER)
            AS attempts,
          shown AS tokenised_pan
        FROM z""",
    )


_SUPPLIER = """
WITH f AS (
  SELECT s_suppkey AS k,
    (s_suppkey % 29 = 0 OR s_suppkey % 31 = 0 OR s_suppkey % 37 = 0 OR s_suppkey % 41 = 0) AS damaged,
    CAST(round(abs(s_acctbal) * 100) AS BIGINT) AS cents
  FROM supplier
)
SELECT 'msg.' || k AS key, NOT damaged AS parsed,
  CASE WHEN damaged THEN NULL WHEN k % 7 IN (0, 4) THEN 'TVN' WHEN k % 7 = 1 THEN 'TCN' WHEN k % 7 = 2 THEN 'ACN'
    WHEN k % 7 = 3 THEN 'TAR' ELSE 'UNKNOWN' END AS message_type,
  CASE WHEN damaged THEN NULL WHEN k % 5 = 0 THEN 'OTHER' ELSE 'PTLFX' END AS record_type,
  CASE WHEN damaged THEN NULL ELSE 'TXN-' || k END AS transaction_id,
  CASE WHEN damaged OR k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN '12'
    ELSE '4' || lpad(CAST(k AS VARCHAR), 15, '0') END AS digital_pan,
  CASE WHEN damaged OR k % 19 = 0 OR k % 17 = 0 THEN NULL ELSE CAST(cents AS DOUBLE) / 100 END AS amount,
  CASE WHEN damaged OR k % 23 = 0 THEN NULL
    ELSE TIMESTAMP '1998-01-01 00:00:00' + to_seconds(k % 86400) END AS event_timestamp
FROM f"""

_SUPPLIER_TEXT = """
  SELECT 'msg.' || k AS key, CASE WHEN k % 29 = 0 THEN body WHEN k % 31 = 0 THEN body || '</Data>junk'
    WHEN k % 37 = 0 THEN '' WHEN k % 41 = 0 THEN '   ' ELSE body || '</Data>' END AS value
  FROM (SELECT k, '<Data>'
    || CASE k % 7 WHEN 0 THEN '<MessageType>TVN</MessageType>' WHEN 1 THEN '<MessageType>TCN</MessageType>'
         WHEN 2 THEN '<MessageType>ACN</MessageType>' WHEN 3 THEN '<MessageType>TAR</MessageType>'
         WHEN 4 THEN '<MessageType>tvn </MessageType>' WHEN 5 THEN '<MessageType>XYZ</MessageType>' ELSE '' END
    || '<RecordType>' || CASE k % 5 WHEN 0 THEN 'OTHER' WHEN 1 THEN ' ptlfx ' ELSE 'PTLFX' END || '</RecordType>'
    || '<TransactionId>TXN-' || k || '</TransactionId>'
    || CASE WHEN k % 11 = 0 THEN '' WHEN k % 13 = 0 THEN '<DigitalPan>12</DigitalPan>'
         ELSE '<DigitalPan>4' || lpad(CAST(k AS VARCHAR), 15, '0') || '</DigitalPan>' END
    || CASE WHEN k % 19 = 0 THEN '' WHEN k % 17 = 0 THEN '<Amount>N/A</Amount>'
         ELSE '<Amount>' || (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || '</Amount>' END
    || '<CurrencyCode>' || CASE k % 3 WHEN 0 THEN 'NZD' WHEN 1 THEN 'AUD' ELSE 'USD' END
    || '</CurrencyCode><ResponseCode>00</ResponseCode><Timestamp>'
    || strftime(TIMESTAMP '1998-01-01 00:00:00' + to_seconds(k % 86400), '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN k % 23 = 0 THEN 'Z' ELSE '' END || '</Timestamp>' AS body
    FROM (SELECT s_suppkey AS k, CAST(round(abs(s_acctbal) * 100) AS BIGINT) AS cents FROM supplier))"""

_POLLS = f"""
WITH texts AS ({_SUPPLIER_TEXT})
SELECT 0 AS poll, key, value FROM texts
UNION ALL SELECT 1, 'msg.' || s_suppkey, '<again/>' FROM supplier WHERE s_acctbal < 5000"""

_TOKEN_LOOKUP = _with(
    _PUBLISHED + _VAULT,
    f"SELECT {_ID}, w.token AS tokenised_pan FROM p LEFT JOIN (SELECT DISTINCT pan, token FROM v) w ON p.pan = w.pan",
)

_OFFERED = _PUBLISHED + _VAULT + ", q AS (SELECT p.*, w.token FROM p JOIN (SELECT DISTINCT pan, token FROM v) w ON p.pan = w.pan)"

_REQUEST = f"""mt AS "messageType", txn AS "transactionId", token AS "tokenisedPan",
  CAST(CAST(amt AS DECIMAL(18, 2)) AS DOUBLE) AS amount, cur AS "currencyCode", rc AS "responseCode", {_ISO} AS "timestamp\""""

_LEDGER = """SELECT 'rtf' AS topic, part AS "partition",
  coalesce(max(CASE WHEN result <> 'RETRY' THEN pos END) + 1, 0) AS committed,
  min(CASE WHEN result = 'RETRY' THEN pos END) AS first_unacked,
  coalesce(min(CASE WHEN result = 'RETRY' THEN pos END),
    max(CASE WHEN result <> 'RETRY' THEN pos END) + 1, 0) AS safe_position
  FROM {rows} GROUP BY part"""

# Neighbouring settled offsets, of rows named a, as intervals.
_ISLANDS = """i AS (
  SELECT part, min(pos) AS "first", max(pos) AS "last"
  FROM (SELECT part, pos, pos - row_number() OVER (PARTITION BY part ORDER BY pos) AS island FROM a) GROUP BY part, island)"""
_ACKED = _OUTCOME + ", a AS (SELECT part, pos FROM r WHERE result <> 'RETRY'), " + _ISLANDS
_RANGES = """SELECT 'rtf' AS topic, part AS "partition", "first", "last" FROM i"""

# In two drops, the odd partitions (odd orders) are settled twice.
_SAVED_TWICE = _with(
    _OUTCOME,
    f"""SELECT {_ID}, {_REQUEST} FROM r
      WHERE tries > 0 AND token IS NOT NULL AND (k % 43 <> 0 OR (k % 86 <> 0 AND part % 2 = 1))""",
)
_TWO_DROPS = "CASE WHEN part % 2 = 1 THEN 2 ELSE 1 END"

ORACLES: dict[str, str] = {
    "parse_messages": _with(
        _PARSED,
        f"""SELECT {_ID}, mt AS message_type, rt AS record_type, txn AS transaction_id, pan AS digital_pan,
          CAST(CAST(amt AS DECIMAL(18, 2)) AS DOUBLE) AS amount, amt AS amount_text, cur AS currency_code, rc AS response_code,
          ts AS event_timestamp, (k % 19 <> 0 AND k % 17 = 0) AS amount_coerced, false AS amount_inexact, {_ISO} AS timestamp_text, (k % 23 = 0) AS timestamp_coerced
        FROM m""",
    ),
    "exact_fields": """
SELECT o_orderkey AS k,
  CASE o_orderkey % 3 WHEN 0 THEN '<amount>' || o_orderkey || '</p:Amount>' WHEN 1 THEN 'TXN-' || o_orderkey END AS transaction_id,
  CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CASE o_orderkey % 4
    WHEN 0 THEN '12345678901234567890' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '.10'
    WHEN 1 THEN CAST(o_custkey AS VARCHAR) || '.12345678901'
    WHEN 2 THEN CAST(o_custkey AS VARCHAR) || '.50'
    ELSE CAST(1 + o_orderkey % 9 AS VARCHAR) || 'E+2147483600' END END AS "amountText",
  (o_orderkey % 5 <> 4 AND o_orderkey % 4 <> 2) AS amount_inexact,
  (o_orderkey % 5 <> 4 AND o_orderkey % 4 IN (0, 3)) OR o_orderkey % 5 = 4 AS amount_missing,
  strftime(o_orderdate, '%Y-%m-%d') || 'T01:02:03.' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') || '789' AS timestamp
FROM orders""",
    "success_requests": _with(_OUTCOME, f"SELECT {_ID}, {_REQUEST} FROM r WHERE result = 'SUCCESS'"),
    "parse_rejects": _with(_TEXT, f"SELECT 'order-' || k AS key, {_ID}, txt AS value FROM t WHERE damaged"),
    "filter_publishable": _with(
        _PUBLISHED, f"SELECT {_ID}, rt AS record_type, mt AS message_type, txn AS transaction_id FROM p"
    ),
    "tokenise_local": _with(
        _PUBLISHED,
        f"""SELECT {_ID}, 'TOK-STUB-' || CASE WHEN length(pan) >= 4 THEN right(pan, 4) ELSE '0000' END
          AS tokenised_pan FROM p""",
    ),
    "tokenise_vault": _TOKEN_LOOKUP,
    "tokenise_vault_salted": _TOKEN_LOOKUP,
    "tokenise_prepared": _TOKEN_LOOKUP,
    "tokenise_service": _with(
        _PUBLISHED + ", s AS (SELECT *, CAST(right(pan, 3) AS INTEGER) AS n FROM p)",
        f"""SELECT {_ID},
          CASE WHEN n % 5 <> 0 THEN 'TOK-SVC-' || right(pan, 6) END AS tokenised_pan,
          CAST(CASE WHEN n IS NULL OR n % 5 = 0 THEN 3 WHEN n % 3 = 0 THEN 2 ELSE 1 END AS INTEGER) AS token_attempts,
          (n IS NULL OR n % 5 = 0) AS failed
        FROM s""",
    ),
    "service_outage": _with(
        _OUTCOME,
        f"""SELECT {_ID}, CASE WHEN tries = 0 THEN 'SKIPPED' ELSE 'RETRY' END AS result,
          CASE WHEN tries = 0 THEN reason ELSE 'TOKENISE_FAILED' END AS reason, true AS once FROM r""",
    ),
    "masked_report": _with(
        _PARSED,
        f"""SELECT {_ID}, txn AS transaction_id, mt AS message_type,
          CASE WHEN length(pan) >= 4 THEN repeat('*', length(pan) - 4) || right(pan, 4) ELSE '****' END AS masked_pan
        FROM m""",
    ),
    "save_requests": _with(_OFFERED, f"SELECT {_ID}, {_REQUEST} FROM q"),
    "save_payloads": _with(
        _OFFERED,
        f"""SELECT {_ID}, '{{"messageType":"' || mt || '","transactionId":"' || txn || '","tokenisedPan":"' || token
          || '","amount":' || coalesce(amt, 'null') || ',"currencyCode":"' || cur || '","responseCode":"' || rc
          || '","timestamp":' || coalesce('"' || {_ISO} || '"', 'null') || '}}' AS body
        FROM q""",
    ),
    "save_service": _with(
        _OUTCOME,
        f"""SELECT {_ID},
          CASE WHEN tries = 0 THEN 'SKIPPED' WHEN k % 10 = 3 THEN 'RETRY' ELSE 'SUCCESS' END AS result,
          CASE WHEN tries = 0 THEN reason WHEN k % 10 = 3 THEN 'SAVE_FAILED' ELSE 'OK' END AS reason,
          CAST(CASE WHEN tries = 0 THEN 0 WHEN k % 10 = 3 OR k % 4 = 1 THEN 3 ELSE 1 END AS INTEGER) AS save_attempts,
          (tries > 0 AND k % 10 = 3) AS failed
        FROM r""",
    ),
    "process_outcomes": _with(
        _OUTCOME,
        f"""SELECT 'rtf' AS topic, {_ID}, CASE WHEN damaged THEN NULL ELSE txn END AS transaction_id,
          CASE WHEN damaged THEN NULL ELSE mt END AS message_type, shown AS tokenised_pan,
          result, reason, CAST(tries AS INTEGER) AS attempts
        FROM r""",
    ),
    "process_local": _with(
        _OUTCOME,
        """SELECT CASE WHEN tries = 0 THEN 'SKIPPED' ELSE 'SUCCESS' END AS result,
          CASE WHEN tries = 0 THEN reason ELSE 'OK' END AS reason,
          count(*) AS records,
          CAST(sum(CASE WHEN tries > 0 THEN CAST(amt AS DECIMAL(18, 2)) END) AS DOUBLE) AS amount,
          count(CASE WHEN tries > 0 THEN ts END) AS timestamps,
          count(DISTINCT CASE WHEN tries > 0 THEN
            CASE WHEN length(pan) >= 4 THEN right(pan, 4) ELSE '0000' END END) AS tokens
        FROM r GROUP BY 1, 2""",
    ),
    "offset_ledger": _with(_OUTCOME, _LEDGER.format(rows="r")),
    "at_risk": _with(
        _OUTCOME
        + ", g AS (SELECT part AS gp, max(pos) + 1 AS committed FROM r WHERE result <> 'RETRY' GROUP BY part)",
        f"""SELECT 'rtf' AS topic, {_ID}, txn AS transaction_id, reason, committed
          FROM r JOIN g ON r.part = g.gp WHERE result = 'RETRY' AND pos < committed""",
    ),
    "retry_queue": _with(
        _OUTCOME,
        f"""SELECT {_ID}, txn AS transaction_id, pan AS digital_pan, CAST(tries AS INTEGER) AS attempts
          FROM r WHERE result = 'RETRY'""",
    ),
    "redelivery": _final("3"),
    "call_health": """
WITH w AS (
  SELECT user_id % 2 AS service, ts, event_id,
    count(*) OVER last_calls AS window_size,
    CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER last_calls AS BIGINT) AS failures
  FROM events
  WINDOW last_calls AS (PARTITION BY user_id % 2 ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
)
SELECT service, ts, event_id, window_size, failures,
  CAST(failures AS DOUBLE) / CAST(window_size AS DOUBLE) AS failure_rate,
  (window_size = 10 AND failures >= 5) AS flagged
FROM w""",
    "stream_health": """
WITH w AS (
  SELECT user_id % 2 AS service, event_id,
    count(*) OVER last_calls AS window_size,
    CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER last_calls AS BIGINT) AS failures
  FROM events
  WINDOW last_calls AS (PARTITION BY user_id % 2 ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
)
SELECT service, event_id, window_size, failures,
  CAST(failures AS DOUBLE) / CAST(window_size AS DOUBLE) AS failure_rate,
  (window_size = 10 AND failures >= 5) AS flagged
FROM w""",
    "outcome_metrics": _with(
        _OUTCOME,
        """SELECT result, reason, CASE WHEN damaged THEN NULL ELSE mt END AS message_type, count(*) AS records,
          count(*) FILTER (WHERE NOT damaged AND k % 19 <> 0 AND k % 17 = 0) AS amounts_coerced, CAST(0 AS BIGINT) AS amounts_inexact,
          count(*) FILTER (WHERE NOT damaged AND k % 23 = 0) AS timestamps_coerced,
          CAST(max(tries) AS INTEGER) AS max_attempts
        FROM r GROUP BY 1, 2, 3""",
    ),
    "codec_roundtrip": _with(_TEXT, f"SELECT 'order-' || k AS key, {_ID}, txt AS value, false AS decrypt_failed FROM t"),
    "encrypted_shape": _with(
        _TEXT,
        """SELECT 'order-' || k AS key, txt IS NOT NULL AS sealed,
          CAST(coalesce(11 + 16 + 1 + 4 * ((strlen(txt) + 16 + 2) // 3), 0) AS INTEGER) AS characters,
          CAST(CASE WHEN txt IS NOT NULL THEN 17 ELSE 0 END AS INTEGER) AS separator
        FROM t""",
    ),
    "publish_partitions": """
WITH keys AS (
  SELECT 'order-' || o_orderkey AS key, length('order-' || o_orderkey) AS n,
    list_transform(range(1, length('order-' || o_orderkey) + 1), lambda i: ascii(substr('order-' || o_orderkey, i, 1))::HUGEINT) AS b
  FROM orders),
words AS (
  SELECT key, n, b, list_transform(range(0, n // 4), lambda i:
    (b[4 * i + 1] + b[4 * i + 2] * 256 + b[4 * i + 3] * 65536 + b[4 * i + 4] * 16777216) * 1540483477 % 4294967296) AS w FROM keys),
mixed AS (
  SELECT key, n, b, list_reduce(list_concat([xor(2538058380::HUGEINT, n::HUGEINT)],
      list_transform(w, lambda k: xor(k, k // 16777216) * 1540483477 % 4294967296)),
    lambda h, k: xor(h * 1540483477 % 4294967296, k)) AS h FROM words),
tails AS (
  SELECT key, CASE n % 4 WHEN 0 THEN h ELSE
    xor(h, b[4 * (n // 4) + 1] + coalesce(b[4 * (n // 4) + 2], 0) * 256 + coalesce(b[4 * (n // 4) + 3], 0) * 65536)
      * 1540483477 % 4294967296 END AS h FROM mixed),
thirteen AS (SELECT key, xor(h, h // 8192) * 1540483477 % 4294967296 AS h FROM tails)
SELECT key, CAST(xor(h, h // 32768) % 2147483648 % 12 AS INTEGER) AS "partition" FROM thirteen""",
    "topic_records": _with(
        _TEXT,
        f"""SELECT CASE WHEN k % 10 <> 0 THEN 'order-' || k END AS key, {_ID},
          CASE WHEN k % 6 = 0 THEN '<Data><TransactionId>T' || chr(65533) || k || '</TransactionId></Data>' ELSE txt END AS value,
          false AS decrypt_failed FROM t""",
    ),
    "decrypt_mixed": _with(_TEXT, f"SELECT 'order-' || k AS key, {_ID}, txt AS value, false AS decrypt_failed FROM t"),
    "decrypt_quarantine": _with(
        _TEXT
        + """, d AS (SELECT *, (part % 2 = 0 AND txt IS NOT NULL AND pos % 3 = 0) AS cut,
            (NOT damaged AND k % 5 <> 0 AND k % 7 IN (0, 1, 2, 4)) AS published FROM t)""",
        f"""SELECT {_ID}, CASE WHEN published AND NOT cut THEN 'SUCCESS' ELSE 'SKIPPED' END AS result,
          CASE WHEN cut THEN 'DECRYPT_FAILED' WHEN damaged THEN 'MALFORMED' WHEN k % 5 = 0 THEN 'NOT_PTLFX'
            WHEN NOT published THEN 'NOT_ACTIONABLE' ELSE 'OK' END AS reason,
          cut AS kept
        FROM d""",
    ),
    "acked_ranges": _with(_ACKED, _RANGES),
    "late_ranges": _with(
        _OUTCOME + ", a AS (SELECT part, pos FROM r WHERE result <> 'RETRY' AND pos % 50 <> 1), " + _ISLANDS, _RANGES
    ),
    "ledger_positions": _with(
        _ACKED,
        """SELECT 'rtf' AS topic, part AS "partition", arg_min("last", "first") + 1 AS safe_position, max("last") + 1 AS committed,
          CAST(max("last") + 1 - min("first") - sum("last" - "first" + 1) AS BIGINT) AS gaps FROM i GROUP BY part""",
    ),
    "resume_offsets": _with(
        _ACKED,
        """SELECT '{"rtf":{' || string_agg('"' || part || '":' || position, ',' ORDER BY part) || '}}' AS starting_offsets
          FROM (SELECT part, CASE WHEN part = 2 THEN -2 ELSE max("last") + 1 END AS position FROM i GROUP BY part)""",
    ),
    "replay_windows": _with(
        _ACKED
        + """, b AS (SELECT part, "last" + 1 AS "first", lead("first") OVER w - 1 AS "last"
              FROM (SELECT * FROM i UNION ALL SELECT DISTINCT part, -1, -1 FROM i) WINDOW w AS (PARTITION BY part ORDER BY "first")),
            h AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY "first") - 1 AS number, count(*) OVER (PARTITION BY part) AS n
              FROM b WHERE "first" <= "last")""",
        """SELECT CAST(number * least(n, 4) // n AS INTEGER) AS "read", 'rtf' AS topic, part AS "partition",
          min("first") AS "first", max("last") AS "last" FROM h GROUP BY ALL""",
    ),
    "unsettled_records": _with(
        _ACKED + """, e AS (SELECT part AS ep, max("last") AS "end" FROM i GROUP BY part)""",
        f"""SELECT 'order-' || k AS key, {_ID} FROM r JOIN e ON part = ep WHERE result = 'RETRY' AND pos <= "end\"""",
    ),
    "live_metrics": _with(
        _OUTCOME
        + """, z AS (SELECT *, 1 - part % 2 AS b FROM r UNION ALL SELECT *, 1 FROM r WHERE part % 2 = 1 AND result = 'RETRY'),
          y AS (SELECT *, tries > 0 AND token IS NOT NULL AND (k % 43 <> 0 OR (part % 2 = 1 AND b = 1 AND k % 86 <> 0)) AS fine FROM z)""",
        """SELECT b AS batch_id, count(*) AS records, count(*) FILTER (WHERE fine) AS succeeded,
          count(*) FILTER (WHERE tries = 0) AS skipped, count(*) FILTER (WHERE tries > 0 AND NOT fine) AS to_retry,
          count(*) FILTER (WHERE NOT damaged AND k % 19 <> 0 AND k % 17 = 0) AS amounts_coerced,
          count(*) FILTER (WHERE NOT damaged AND k % 23 = 0) AS timestamps_coerced,
          count(*) FILTER (WHERE damaged) AS "MALFORMED",
          count(*) FILTER (WHERE tries > 0 AND token IS NOT NULL AND NOT fine) AS "SAVE_FAILED" FROM y GROUP BY b""",
    ),
    "due_outcomes": _final("3"),
    "due_batches": _with(
        _OUTCOME,
        """SELECT CAST(batch_id AS INTEGER) AS batch_id, count(*) AS records FROM (
          SELECT 1 - part % 2 AS batch_id FROM r
          UNION ALL SELECT 2 FROM r WHERE result = 'RETRY'
          UNION ALL SELECT 4 FROM r WHERE result = 'RETRY' AND (token IS NULL OR k % 86 = 0)) GROUP BY 1""",
    ),
    "stream_outcomes": _final("1"),
    "stream_redelivery": _final(_TWO_DROPS),
    "stream_transactions": _SAVED_TWICE,
    "keyed_transactions": _SAVED_TWICE,
    "stream_acked": _with(
        _OUTCOME
        + """, a AS (SELECT part, pos FROM r WHERE tries = 0 OR
            (token IS NOT NULL AND (k % 43 <> 0 OR (k % 86 <> 0 AND part % 2 = 1)))), """
        + _ISLANDS,
        _RANGES,
    ),
    "stream_ledger": _with(
        _OUTCOME
        + """, z AS (SELECT part, pos, CASE WHEN tries = 0 THEN 'SKIPPED'
            WHEN token IS NULL OR (k % 43 = 0 AND NOT (k % 86 <> 0 AND part % 2 = 1)) THEN 'RETRY'
            ELSE 'SUCCESS' END AS result FROM r)""",
        _LEDGER.format(rows="z"),
    ),
    "folder_feed": _SUPPLIER,
    "folder_changes": "SELECT 'msg.' || s_suppkey AS key, '<again/>' AS value FROM supplier WHERE s_acctbal < 5000",
    "folder_polls": _POLLS,
    "folder_watch": _POLLS,
    "folder_stream": _SUPPLIER,
}

"""SQL counterparts of the queries, in a plain join / row_number / union style.

Deliberately shaped unlike the DataFrame jobs, so that the two check each other.
"""

from __future__ import annotations

WEEK = "199826"

# -- building blocks -----------------------------------------------------------


def _us_week(day: str) -> str:
    saturday = f"({day} + (6 - dayofweek({day}))::INTEGER)"
    return (
        f"CAST(year({saturday}) * 100 + (dayofyear({saturday}) + 6) // 7 AS VARCHAR)"
    )


def _ymd(day: str) -> str:
    return f"strftime({day}, '%Y%m%d')"


def _pad(value: str, width: int) -> str:
    return f"lpad(CAST({value} AS VARCHAR), {width}, '0')"


def _ratio(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)"


def _rounded(value: str) -> str:
    return f"floor(({value}) * 1000000 + 0.5) / 1000000"


CALENDAR = f"""
saturdays AS (
  SELECT CAST(d AS DATE) AS d
  FROM generate_series(DATE '1990-01-01', DATE '2030-12-31', INTERVAL 1 DAY) g(d)
  WHERE dayofweek(d) = 6),
weektable AS (
  SELECT {_us_week('d')} AS BSE_YW,
         CAST(year(d) AS VARCHAR) || CAST((dayofyear(d) + 6) // 7 AS VARCHAR) AS week2,
         {_ymd('d')} || '010000000000' AS closing
  FROM saturdays)"""

ORDERS = """
o AS (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)"""

LINES = """
ln AS (
  SELECT l_orderkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)) AS qty,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
           l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag,
           l_linestatus) - 1 AS seq
  FROM lineitem)"""

MASTERS = """
mdm_cryr AS (
  SELECT 'C' || s_suppkey AS carrierCode, s_name AS carrierName FROM supplier),
mdm_port AS (
  SELECT 'P' || n_nationkey AS locCd, n_name AS locNm FROM nation)"""

MARKET = "CASE WHEN o_orderstatus = 'P' THEN '02' ELSE '01' END"
SIDE = "CASE WHEN o_orderstatus = 'O' THEN 'B' ELSE 'S' END"

DEALS = f"""{ORDERS},{LINES},{MASTERS},
ftr_deal AS (
  SELECT o_orderkey AS ID, 'D' || {_pad('o_orderkey', 10)} AS DEAL_NR,
         CAST(0 AS BIGINT) AS DEAL_CHNG_SEQ,
         {_ymd('day')} || {_pad('o_orderkey', 12)} AS DEAL_DT, {MARKET} AS marketTypeCode,
         '01' AS rdTermCode, '01' AS paymentTermCode, {SIDE} AS offerTypeCode
  FROM o),
ftr_line AS (
  SELECT l_orderkey * 1000000 + CAST(BSE_YW AS BIGINT) AS ID,
         'D' || {_pad('l_orderkey', 10)} AS DEAL_NR, CAST(0 AS BIGINT) AS DEAL_CHNG_SEQ, BSE_YW,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DEAL_AMT,
         max(CAST(l_extendedprice AS DECIMAL(18,2))) AS DEAL_PRCE,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DEAL_QTY
  FROM (SELECT *, {_us_week('CAST(l_shipdate AS DATE)')} AS BSE_YW FROM lineitem)
  GROUP BY l_orderkey, BSE_YW),
ftr_cryr AS (
  SELECT DISTINCT l_orderkey * 100 + l_suppkey % 12 AS ID,
         'D' || {_pad('l_orderkey', 10)} AS DEAL_NR, CAST(0 AS BIGINT) AS DEAL_CHNG_SEQ,
         'C' || (l_suppkey % 12) AS carrierCode
  FROM ln),
ftr_rte AS (
  SELECT o_orderkey * 100 + 20 + c_nationkey % 5 AS ID, 'D' || {_pad('o_orderkey', 10)} AS DEAL_NR,
         CAST(0 AS BIGINT) AS DEAL_CHNG_SEQ, '02' AS tp, 'P' || (c_nationkey % 5) AS loc
  FROM o JOIN customer ON o_custkey = c_custkey
  UNION ALL
  SELECT DISTINCT l_orderkey * 100 + 30 + s_nationkey % 5, 'D' || {_pad('l_orderkey', 10)}, CAST(0 AS BIGINT), '03',
         'P' || (s_nationkey % 5)
  FROM ln JOIN supplier ON l_suppkey = s_suppkey),
rte AS (
  SELECT k.DEAL_NR, k.DEAL_CHNG_SEQ, pol.loc AS polCode, pod.loc AS podCode
  FROM (SELECT DISTINCT DEAL_NR, DEAL_CHNG_SEQ FROM ftr_rte) k
  LEFT JOIN (SELECT * FROM ftr_rte WHERE tp = '02') pol USING (DEAL_NR, DEAL_CHNG_SEQ)
  LEFT JOIN (SELECT * FROM ftr_rte WHERE tp = '03') pod USING (DEAL_NR, DEAL_CHNG_SEQ)),
fact AS (
  SELECT c.carrierCode, d.DEAL_NR, d.DEAL_CHNG_SEQ, d.DEAL_DT, d.marketTypeCode, d.rdTermCode,
         d.paymentTermCode, d.offerTypeCode, r.polCode, r.podCode, l.BSE_YW AS baseYearWeek,
         l.DEAL_AMT AS dealAmt, l.DEAL_PRCE AS dealPrice, l.DEAL_QTY AS dealQty, m.carrierName
  FROM ftr_deal d
  LEFT JOIN rte r USING (DEAL_NR, DEAL_CHNG_SEQ)
  LEFT JOIN ftr_line l USING (DEAL_NR, DEAL_CHNG_SEQ)
  LEFT JOIN ftr_cryr c USING (DEAL_NR, DEAL_CHNG_SEQ)
  LEFT JOIN mdm_cryr m USING (carrierCode)
  WHERE d.offerTypeCode = 'S')"""

TERMS = "marketTypeCode, rdTermCode, paymentTermCode, polCode, podCode"
ROUTE = (
    "marketTypeCode, rdTermCode, '01' AS containerTypeCode, paymentTermCode, polCode, podCode, "
    "'T' AS qtyUnit"
)
ROUTE_NAMES = (
    "marketTypeCode, rdTermCode, containerTypeCode, paymentTermCode, polCode, podCode, qtyUnit"
)


def _weekly(source: str) -> str:
    """Weekly OHLC with flags for the first and last row of a week."""
    return f"""
SELECT {TERMS}, baseYearWeek, max(dealPrice) AS high, min(dealPrice) AS low,
       CAST(sum(dealQty) AS DECIMAL(28,2)) AS volume, max(DEAL_DT) AS latestEventDate,
       CAST(sum(CASE WHEN rn = 1 THEN dealPrice ELSE 0 END) AS DECIMAL(18,2)) AS open,
       CAST(sum(CASE WHEN rd = 1 THEN dealPrice ELSE 0 END) AS DECIMAL(18,2)) AS close
FROM (SELECT *, row_number() OVER (PARTITION BY {TERMS}, baseYearWeek ORDER BY DEAL_DT) AS rn,
             row_number() OVER (PARTITION BY {TERMS}, baseYearWeek ORDER BY DEAL_DT DESC) AS rd
      FROM {source})
GROUP BY {TERMS}, baseYearWeek"""


def _sum_select(source: str, lagged: str) -> str:
    change = f"(close - {lagged})"
    return f"""
SELECT {ROUTE}, baseYearWeek,
       CASE WHEN baseYearWeek >= '{WEEK}' THEN 'on Market' ELSE 'Trade Closed' END AS status,
       open, low, high, close, volume, CAST({change} AS DECIMAL(18,2)) AS changeValue,
       {_rounded(_ratio(change, 'close'))} AS changeRate, latestEventDate
FROM ({_weekly(source)})"""


def _history(source: str) -> str:
    along = (
        f"PARTITION BY {TERMS}, baseYearWeek "
        "ORDER BY DEAL_DT, DEAL_NR, DEAL_CHNG_SEQ, carrierName NULLS FIRST"
    )
    change = "CAST(dealPrice - lagged AS DECIMAL(18,2))"
    return f"""
SELECT {ROUTE}, baseYearWeek, idx, DEAL_DT AS timestamp, DEAL_NR AS referenceEventNumber,
       DEAL_CHNG_SEQ AS referenceEventChangeNumber, dealQty, dealPrice, dealAmt,
       {change} AS priceChange, {_rounded(_ratio(change, 'dealPrice'))} AS priceRate
FROM (SELECT *, lag(dealPrice, 1, 0) OVER ({along}) AS lagged, row_number() OVER ({along}) AS idx
      FROM (SELECT DISTINCT * EXCLUDE (carrierCode) FROM {source}
            WHERE dealQty <> 0 AND offerTypeCode = 'S'))"""


def _detail(source: str) -> str:
    labels = {
        "daily": "substr(DEAL_DT, 1, 8)",
        "weekly": "substr(DEAL_DT, 1, 4) || "
        "CAST(weekofyear(strptime(substr(DEAL_DT, 1, 8), '%Y%m%d')) AS VARCHAR)",
        "monthly": "substr(DEAL_DT, 1, 6)",
    }
    parts = []
    for interval, label in labels.items():
        keys = f"{TERMS}, baseYearWeek, xAxis"
        parts.append(f"""
SELECT *, close - lag(close, 1, 0) OVER (PARTITION BY {TERMS}, baseYearWeek
                                         ORDER BY intervalTimestamp) AS changeValue
FROM (SELECT {keys}, '{interval}' AS interval, max(dealPrice) AS high, min(dealPrice) AS low,
             max(CASE WHEN rn = 1 THEN dealPrice ELSE 0 END) AS open,
             max(CASE WHEN rd = 1 THEN dealPrice ELSE 0 END) AS close,
             CAST(sum(dealQty) AS DECIMAL(28,2)) AS volume, max(DEAL_DT) AS intervalTimestamp
      FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY DEAL_DT) AS rn,
                   row_number() OVER (PARTITION BY {keys} ORDER BY DEAL_DT DESC) AS rd
            FROM (SELECT *, {label} AS xAxis FROM {source} WHERE dealPrice <> 0))
      GROUP BY {keys})""")
    return f"""
SELECT {ROUTE}, baseYearWeek, interval, xAxis, intervalTimestamp,
       CAST(open AS DECIMAL(18,2)) AS open, low, high, CAST(close AS DECIMAL(18,2)) AS close,
       volume, CAST(changeValue AS DECIMAL(18,2)) AS changeValue,
       {_rounded(_ratio('changeValue', 'close'))} AS changeRate
FROM ({' UNION ALL '.join(parts)})"""


def _cells(rows: str, keys: str, field: str, order: str) -> str:
    return f"""
SELECT {keys}, CAST(count(*) AS INTEGER) AS cells,
       coalesce(string_agg(CAST({field} AS VARCHAR), ',' ORDER BY {order}), '') AS items
FROM ({rows}) GROUP BY ALL"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# -- index series ----------------------------------------------------------------

SERIES = "idxSubject, idxCategory, idxCd, idxNm"

INDEX = f"""{ORDERS},{CALENDAR},
quotes AS (
  SELECT DISTINCT 'orders' AS idxSubject, o_orderstatus AS idxCategory,
         substr(o_orderpriority, 1, 1) AS idxCd, o_orderstatus || '-' || o_orderpriority AS idxNm,
         CAST(o_totalprice AS DECIMAL(18,2)) AS value, CAST(year(day) AS VARCHAR) AS yearly,
         strftime(day, '%Y%m') AS monthly,
         CAST(year(day) AS VARCHAR) || CAST(weekofyear(day) AS VARCHAR) AS weekly
  FROM o)"""


def _index(weekly_order: str) -> str:
    parts = []
    for interval, order, end in (
        ("weekly", weekly_order, _closing_week2()),
        ("monthly", "xAxis", "xAxis || '20010000000000'"),
        ("yearly", "xAxis", "xAxis || '1220010000000000'"),
    ):
        parts.append(f"""
SELECT {SERIES}, '{interval}' AS interval, xAxis, {end} AS intervalTimestamp, value,
       value - lag(value, 1, 0) OVER (PARTITION BY idxNm
                                      ORDER BY {order}, idxSubject, idxCategory, idxCd) AS change
FROM (SELECT {SERIES}, {interval} AS xAxis,
             CAST(sum(value) AS DOUBLE) / CAST(count(value) AS DOUBLE) AS value
      FROM quotes GROUP BY {SERIES}, {interval})""")
    return f"""
SELECT {SERIES}, interval, xAxis, intervalTimestamp, {_rounded('value')} AS value,
       {_rounded('change')} AS changeValue, {_rounded(_ratio('change', 'value'))} AS changeRate,
       CAST(0 AS DOUBLE) AS volume
FROM ({' UNION ALL '.join(parts)})"""


def _closing_week2() -> str:
    return "(SELECT max(closing) FROM weektable w WHERE w.week2 = xAxis)"


INTERVALS = """
intervals(intervalSeq, interval) AS (VALUES (1, 'tick'), (2, 'secondly'), (3, '10sec'),
  (4, '30sec'), (5, 'minutely'), (6, '5min'), (7, '10min'), (8, '30min'), (9, 'hourly'),
  (10, 'daily'), (11, 'weekly'), (12, 'monthly'), (13, 'yearly'))"""


# -- offers ------------------------------------------------------------------------

OFFERS = f"""{ORDERS},{LINES},{MASTERS},{CALENDAR},
ov AS (
  SELECT *, 'F' || {_ymd('day')} || {_pad('o_orderkey', 12)} AS OFER_NR, seq AS OFER_CHNG_SEQ,
         'U' || (o_custkey % 50) AS EMP_NR,
         coalesce(sum(CASE WHEN seq > 0 THEN qty END) OVER (PARTITION BY o_orderkey ORDER BY seq),
                  0) AS dealt
  FROM o JOIN ln ON o_orderkey = l_orderkey),
ftr_ofer AS (
  SELECT OFER_NR, OFER_CHNG_SEQ, {SIDE} AS OFER_TP_CD, EMP_NR,
         CAST(o_orderkey % 2 AS VARCHAR) AS ALL_YN, {MARKET} AS TRDE_MKT_TP_CD,
         '01' AS OFER_RD_TRM_CD, '01' AS OFER_PYMT_TRM_CD
  FROM ov),
ftr_line AS (
  SELECT OFER_NR, OFER_CHNG_SEQ, BSE_YW,
         CAST(sold * price AS DECIMAL(18,2)) AS DEAL_AMT, price AS DEAL_PRCE, sold AS DEAL_QTY,
         price AS OFER_PRCE, CAST(100 AS DECIMAL(18,2)) AS OFER_QTY,
         CAST(greatest(100 - dealt, 0) AS DECIMAL(18,2)) AS OFER_REMN_QTY,
         '01' AS TRDE_CONT_TP_CD
  FROM (SELECT *, CAST(CASE WHEN seq > 0 THEN qty ELSE 0 END AS DECIMAL(18,2)) AS sold,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2))
                    AS DECIMAL(18,2)) AS price,
               unnest([{_us_week('(day + 14)')}, {_us_week('(day + 21)')}]) AS BSE_YW
        FROM ov)),
ftr_deal AS (
  SELECT 'D' || {_pad('o_orderkey', 10)} || '-' || seq AS DEAL_NR,
         CAST(0 AS BIGINT) AS DEAL_CHNG_SEQ,
         {_ymd('(day + CAST(seq AS INTEGER))')} || {_pad('o_orderkey', 12)} AS DEAL_DT,
         OFER_NR, seq - 1 AS OFER_CHNG_SEQ, EMP_NR
  FROM ov WHERE seq >= 1),
ftr_rte AS (
  SELECT OFER_NR, OFER_CHNG_SEQ, '02' AS tp, 'P' || (c_nationkey % 5) AS loc
  FROM ov JOIN customer ON o_custkey = c_custkey
  UNION ALL
  SELECT OFER_NR, OFER_CHNG_SEQ, '03', 'P' || (s_nationkey % 5)
  FROM ov JOIN supplier ON l_suppkey = s_suppkey),
ftr_cryr AS (
  SELECT DISTINCT a.OFER_NR, a.OFER_CHNG_SEQ, 'C' || (b.l_suppkey % 12) AS carrierCode
  FROM ov a JOIN ov b ON a.OFER_NR = b.OFER_NR AND b.seq <= a.seq),
cryr AS (
  SELECT OFER_NR, OFER_CHNG_SEQ, count(DISTINCT carrierCode) AS carrierCount,
         string_agg(carrierCode || ':' || coalesce(carrierName, '-'), ',' ORDER BY carrierCode)
           AS carrierItem,
         string_agg(carrierCode, ',' ORDER BY carrierCode) AS codes
  FROM ftr_cryr LEFT JOIN mdm_cryr USING (carrierCode) GROUP BY OFER_NR, OFER_CHNG_SEQ),
rte AS (
  SELECT k.OFER_NR, k.OFER_CHNG_SEQ, pol.loc AS polCode, pod.loc AS podCode,
         p1.locNm AS polName, p2.locNm AS podName
  FROM (SELECT DISTINCT OFER_NR, OFER_CHNG_SEQ FROM ftr_rte) k
  LEFT JOIN (SELECT * FROM ftr_rte WHERE tp = '02') pol USING (OFER_NR, OFER_CHNG_SEQ)
  LEFT JOIN (SELECT * FROM ftr_rte WHERE tp = '03') pod USING (OFER_NR, OFER_CHNG_SEQ)
  LEFT JOIN mdm_port p1 ON p1.locCd = pol.loc
  LEFT JOIN mdm_port p2 ON p2.locCd = pod.loc),
raw AS (
  SELECT f.OFER_NR, f.OFER_CHNG_SEQ, l.BSE_YW, f.OFER_TP_CD, f.EMP_NR, f.ALL_YN, c.carrierCount,
         c.carrierItem, r.polCode, r.podCode, r.polName, r.podName, l.DEAL_AMT, l.DEAL_PRCE,
         l.DEAL_QTY, l.OFER_PRCE, l.OFER_QTY, l.OFER_REMN_QTY
  FROM (SELECT DISTINCT OFER_NR, OFER_CHNG_SEQ, OFER_TP_CD, EMP_NR, ALL_YN FROM ftr_ofer) f
  LEFT JOIN cryr c USING (OFER_NR, OFER_CHNG_SEQ)
  LEFT JOIN rte r USING (OFER_NR, OFER_CHNG_SEQ)
  LEFT JOIN (SELECT DISTINCT * FROM ftr_line) l USING (OFER_NR, OFER_CHNG_SEQ)),
latest AS (
  SELECT f.OFER_NR, f.OFER_CHNG_SEQ, OFER_TP_CD, EMP_NR, ALL_YN, BSE_YW, DEAL_AMT, DEAL_PRCE,
         DEAL_QTY, OFER_PRCE, OFER_QTY, OFER_REMN_QTY
  FROM ftr_ofer f LEFT JOIN ftr_line l USING (OFER_NR, OFER_CHNG_SEQ)
  QUALIFY row_number() OVER (PARTITION BY f.OFER_NR, l.BSE_YW ORDER BY f.OFER_CHNG_SEQ DESC) = 1),
next_deal AS (
  SELECT OFER_NR, OFER_CHNG_SEQ + 1 AS OFER_CHNG_SEQ, DEAL_NR, DEAL_CHNG_SEQ, DEAL_DT
  FROM ftr_deal),
rtcnt AS (
  SELECT OFER_NR AS offerNumber, OFER_CHNG_SEQ AS offerChangeSeq,
         count(DISTINCT polCode) AS polCount, count(DISTINCT podCode) AS podCount,
         string_agg(coalesce(polCode, '-') || ':' || coalesce(polName, '-') || ':' ||
                    coalesce(podCode, '-') || ':' || coalesce(podName, '-'), ',') AS routeItem,
         string_agg(coalesce(polCode, '-') || ':' || coalesce(podCode, '-'), ',') AS routeShort
  FROM (SELECT DISTINCT OFER_NR, OFER_CHNG_SEQ, polCode, podCode, polName, podName FROM raw)
  GROUP BY OFER_NR, OFER_CHNG_SEQ),
li AS (
  SELECT EMP_NR AS userId, OFER_TP_CD AS offerTypeCode, OFER_NR AS offerNumber,
         OFER_CHNG_SEQ AS offerChangeSeq, ALL_YN AS allYn, BSE_YW AS baseYearWeek,
         DEAL_QTY AS dealQty, OFER_REMN_QTY AS leftQty,
         CASE WHEN OFER_REMN_QTY <> 0 THEN OFER_REMN_QTY * OFER_PRCE ELSE 0 END AS leftAmt,
         coalesce(DEAL_DT, substr(OFER_NR, 2, 21)) AS ts,
         coalesce(DEAL_NR, OFER_NR) AS ref,
         coalesce(DEAL_CHNG_SEQ, OFER_CHNG_SEQ) AS refSeq
  FROM latest LEFT JOIN next_deal USING (OFER_NR, OFER_CHNG_SEQ)),
summary AS (
  SELECT *, CASE WHEN (maxWeek > '{WEEK}' AND minWeek < '{WEEK}' AND allYn = '0' AND leftTotal > 0)
                   OR (minWeek > '{WEEK}' AND leftTotal > 0) THEN '0' ELSE '1' END AS offerStatus
  FROM (SELECT userId, offerTypeCode, offerNumber, offerChangeSeq, allYn,
               string_agg(baseYearWeek || ':' || dealQty || ':' || leftQty || ':' || ts || ':' ||
                          ref || ':' || refSeq, ',' ORDER BY baseYearWeek) AS lineItem,
               count(*) AS lineCount,
               max(ts) AS eventTimestamp, max(ref) AS referenceEventNumber,
               max(refSeq) AS referenceEventChangeSeq, max(baseYearWeek) AS maxWeek,
               min(baseYearWeek) AS minWeek, sum(leftAmt) AS leftTotal
        FROM li GROUP BY userId, offerTypeCode, offerNumber, offerChangeSeq, allYn)),
base AS (
  SELECT l.OFER_NR AS offerNumber, f.ALL_YN AS allYn, f.OFER_TP_CD AS offerTypeCode,
         l.OFER_CHNG_SEQ AS offerChangeSeq, l.BSE_YW AS baseYearWeek, l.DEAL_PRCE AS dealPrice,
         l.DEAL_QTY AS dealQty, l.DEAL_AMT AS dealAmt, l.OFER_PRCE AS offerPrice,
         l.OFER_QTY AS offerQty, CAST(l.OFER_PRCE * l.OFER_QTY AS DECIMAL(28,2)) AS offerAmt,
         l.OFER_PRCE AS leftPrice, l.OFER_REMN_QTY AS leftQty,
         CAST(l.OFER_PRCE * l.OFER_REMN_QTY AS DECIMAL(28,2)) AS leftAmt,
         d.DEAL_NR, d.DEAL_CHNG_SEQ, d.DEAL_DT, w.closing
  FROM ftr_line l
  LEFT JOIN ftr_deal d USING (OFER_NR, OFER_CHNG_SEQ)
  LEFT JOIN ftr_ofer f USING (OFER_NR, OFER_CHNG_SEQ)
  LEFT JOIN weektable w USING (BSE_YW))"""

LOG_AMOUNTS = (
    "baseYearWeek, dealPrice, dealQty, dealAmt, offerPrice, offerQty, offerAmt, leftPrice, "
    "leftQty, leftAmt"
)
EVENT_NAMES = {
    "01": "offerPlaced",
    "02": "offerDealt",
    "03": "weekExpired",
    "04": "allDealt",
    "05": "offerClosed",
}


def _event(code: str) -> str:
    """Log rows of one event, each event in its own pass as the rules state them."""
    version = "offerNumber, offerTypeCode, allYn, offerChangeSeq"
    own = "offerNumber AS ref, offerChangeSeq AS refSeq"
    deal = "DEAL_NR AS ref, DEAL_CHNG_SEQ AS refSeq"
    source, reference, time, closing = "base", own, "DEAL_DT", "closing"
    last_by, keep = "offerNumber", "TRUE"
    if code == "01":
        source, time = "(SELECT * FROM base WHERE offerChangeSeq = 0)", "substr(offerNumber, 2, 21)"
    elif code == "02":
        source, reference = "(SELECT * FROM base WHERE offerChangeSeq > 0)", deal
        last_by, keep = "offerNumber, offerChangeSeq", "ref IS NOT NULL"
    elif code == "03":
        source, time = f"(SELECT * FROM base WHERE baseYearWeek < '{WEEK}')", "closing"
        keep = "offerChangeSeq = lastVersion"
    elif code == "04":
        keep = "leftSum = 0"
    else:
        closing = "CASE WHEN DEAL_DT > closing THEN DEAL_DT ELSE closing END"
        source = "(SELECT DISTINCT * EXCLUDE (DEAL_NR, DEAL_CHNG_SEQ) FROM base)"
        keep = f"offerChangeSeq = lastVersion AND (leftSum = 0 OR lastWeek < '{WEEK}')"
    return f"""
SELECT DISTINCT offerNumber, allYn, offerTypeCode, '{code}' AS eventCode,
       '{EVENT_NAMES[code]}' AS eventName, lastTime AS lastEventTimestamp,
       'F9_SYSTETM_ADMIN' AS lastEventHost, time AS eventTimestamp, ref AS referenceEventNumber,
       refSeq AS referenceEventNumberChangeSeq, {LOG_AMOUNTS}, tradeClosing
FROM (SELECT *, max(time) OVER (PARTITION BY {last_by}) AS lastTime,
             max(offerChangeSeq) OVER (PARTITION BY offerNumber) AS lastVersion,
             sum(leftQty) OVER (PARTITION BY {version}) AS leftSum,
             max(baseYearWeek) OVER (PARTITION BY {version}) AS lastWeek
      FROM (SELECT *, {reference}, {time} AS time, {closing} AS tradeClosing FROM {source}))
WHERE {keep}"""


def _event_log() -> str:
    parts = " UNION ALL ".join(
        # Event 04 closes versions one by one, so each of them is a cell.
        f"SELECT offerNumber, allYn, offerTypeCode, eventCode, "
        f"{'referenceEventNumberChangeSeq' if code != '02' else 'referenceEventNumber'}::VARCHAR "
        f"AS cell FROM ({_event(code)})"
        for code in EVENT_NAMES
    )
    return f"""
SELECT offerNumber, allYn, offerTypeCode, 0 AS page, CAST(count(*) AS INTEGER) AS cells,
       string_agg(eventCode, ',' ORDER BY eventCode) AS eventCodes,
       CAST(sum(entries) AS INTEGER) AS logEntries
FROM (SELECT offerNumber, allYn, offerTypeCode, eventCode, cell, count(*) AS entries
      FROM ({parts}) GROUP BY ALL)
GROUP BY offerNumber, allYn, offerTypeCode"""


WEEK_DETAIL = f"""
SELECT DISTINCT offerNumber, baseYearWeek, offerChangeSeq,
       CAST(aggDealQty AS DECIMAL(28,2)) AS aggDealQty,
       {_rounded(_ratio('aggDealAmt', 'aggDealQty'))} AS aggDealPrice,
       CAST(aggDealAmt AS DECIMAL(28,2)) AS aggDealAmt,
       CAST(aggOfferQty AS DECIMAL(28,2)) AS aggOfferQty,
       CAST(aggLeftQty AS DECIMAL(28,2)) AS aggLeftQty, leftPrice AS aggLeftPrice,
       CAST(aggLeftAmt AS DECIMAL(28,2)) AS aggLeftAmt, closing AS tradeClosing,
       DEAL_DT AS eventTimestamp, DEAL_NR AS referenceEventNumber,
       DEAL_CHNG_SEQ AS referenceEventChangeSeq, CAST(dealQty AS DECIMAL(18,2)) AS dealQty,
       dealPrice, CAST(dealAmt AS DECIMAL(28,2)) AS dealAmt, offerQty, leftQty, leftPrice,
       CAST(leftAmt AS DECIMAL(28,2)) AS leftAmt
FROM (SELECT *, sum(dealQty) OVER w AS aggDealQty, sum(dealAmt) OVER w AS aggDealAmt,
             sum(offerQty) OVER w AS aggOfferQty, min(leftQty) OVER w AS aggLeftQty,
             min(leftAmt) OVER w AS aggLeftAmt, max(offerChangeSeq) OVER w AS lastVersion
      FROM (SELECT *, dealQty * dealPrice AS dealAmt FROM (
              SELECT OFER_NR AS offerNumber, BSE_YW AS baseYearWeek,
                     OFER_CHNG_SEQ AS offerChangeSeq, DEAL_DT, DEAL_NR, DEAL_CHNG_SEQ,
                     DEAL_PRCE AS dealPrice, OFER_QTY AS offerQty, OFER_REMN_QTY AS leftQty,
                     OFER_PRCE AS leftPrice, closing,
                     CASE WHEN OFER_REMN_QTY <> 0 THEN OFER_REMN_QTY * OFER_PRCE ELSE 0 END
                       AS leftAmt,
                     CASE WHEN OFER_CHNG_SEQ = 0 THEN 0
                          ELSE lag(OFER_REMN_QTY, 1, 0) OVER (PARTITION BY OFER_NR, BSE_YW
                                 ORDER BY OFER_CHNG_SEQ) - OFER_REMN_QTY END AS dealQty
              FROM ftr_line LEFT JOIN next_deal USING (OFER_NR, OFER_CHNG_SEQ)
              LEFT JOIN weektable USING (BSE_YW)))
      WINDOW w AS (PARTITION BY offerNumber, baseYearWeek))
WHERE offerChangeSeq = lastVersion AND (offerChangeSeq = 0 OR dealQty > 0)"""


def _week_list() -> str:
    levels = []
    for pol, pod in (("'all'", "'all'"), ("polCode", "'all'"), ("'all'", "podCode"),
                     ("polCode", "podCode")):
        levels.append(
            f"SELECT userId, offerTypeCode, {pol} AS polCode, {pod} AS podCode, "
            "coalesce(string_agg(DISTINCT BSE_YW, ',' ORDER BY BSE_YW), '') AS baseYearWeek "
            "FROM placed GROUP BY ALL"
        )
    return f""",
placed AS (
  SELECT userId, offerTypeCode, polCode, podCode, BSE_YW
  FROM (SELECT OFER_NR, OFER_TP_CD AS offerTypeCode, max(OFER_CHNG_SEQ) AS OFER_CHNG_SEQ,
               min(EMP_NR) AS userId FROM ftr_ofer GROUP BY OFER_NR, OFER_TP_CD)
  LEFT JOIN (SELECT OFER_NR, BSE_YW, max(OFER_CHNG_SEQ) AS OFER_CHNG_SEQ FROM ftr_line
             GROUP BY OFER_NR, BSE_YW) USING (OFER_NR, OFER_CHNG_SEQ)
  LEFT JOIN (SELECT polCode, podCode, OFER_NR, max(OFER_CHNG_SEQ) AS OFER_CHNG_SEQ FROM rte
             WHERE polCode IS NOT NULL GROUP BY ALL) USING (OFER_NR, OFER_CHNG_SEQ))
{' UNION '.join(levels)}"""


ROUTE_LIST = """
SELECT userId, offerTypeCode,
       string_agg(coalesce(polCode, '-') || ':' || coalesce(podCode, '-') || ':' ||
                  coalesce(polName, '-') || ':' || coalesce(podName, '-'), ','
                  ORDER BY polCode NULLS FIRST, podCode NULLS FIRST) AS rteList
FROM (SELECT DISTINCT f.EMP_NR AS userId, f.OFER_TP_CD AS offerTypeCode, pol.loc AS polCode,
             pod.loc AS podCode, p1.locNm AS polName, p2.locNm AS podName
      FROM ftr_ofer f
      LEFT JOIN (SELECT * FROM ftr_rte WHERE tp = '02') pol USING (OFER_NR)
      LEFT JOIN (SELECT * FROM ftr_rte WHERE tp = '03') pod USING (OFER_NR)
      LEFT JOIN mdm_port p1 ON p1.locCd = pol.loc
      LEFT JOIN mdm_port p2 ON p2.locCd = pod.loc)
GROUP BY userId, offerTypeCode"""

BOOK = f"""
SELECT DISTINCT TRDE_MKT_TP_CD AS marketTypeCode, OFER_TP_CD AS offerTypeCode,
       BSE_YW AS baseYearWeek, OFER_PYMT_TRM_CD AS paymentTermCode,
       OFER_RD_TRM_CD AS rdTermCode, TRDE_CONT_TP_CD AS containerTypeCode, polCode, podCode,
       OFER_NR AS tradeOfferNumber, OFER_CHNG_SEQ AS tradeOfferChangeSeq, carrierCode,
       coalesce(carrierCount, 0) AS carrierCount, polCode AS headPolCode, podCode AS headPodCode,
       polName AS headPolName, podName AS headPodName, polCount, podCount,
       {_rounded('avgQty')} AS avgQty,
       {_rounded('avgPrice')} AS avgPrice, ALL_YN AS allYn, minYearWeek,
       maxYearWeek, maxPrice, minPrice
FROM (SELECT OFER_NR, max(OFER_CHNG_SEQ) AS OFER_CHNG_SEQ FROM ftr_ofer GROUP BY OFER_NR)
JOIN (SELECT OFER_NR, OFER_CHNG_SEQ, loc AS polCode, locNm AS polName,
             count(loc) OVER (PARTITION BY OFER_NR, OFER_CHNG_SEQ) AS polCount
      FROM ftr_rte LEFT JOIN mdm_port ON locCd = loc WHERE tp = '02')
  USING (OFER_NR, OFER_CHNG_SEQ)
LEFT JOIN (SELECT OFER_NR, OFER_CHNG_SEQ, loc AS podCode, locNm AS podName,
                  count(loc) OVER (PARTITION BY OFER_NR, OFER_CHNG_SEQ) AS podCount
           FROM ftr_rte LEFT JOIN mdm_port ON locCd = loc WHERE tp = '03')
  USING (OFER_NR, OFER_CHNG_SEQ)
LEFT JOIN (SELECT *, CAST(sum(OFER_PRCE) OVER v AS DOUBLE) / count(OFER_PRCE) OVER v AS avgPrice,
                  CAST(sum(OFER_REMN_QTY) OVER v AS DOUBLE) / count(OFER_REMN_QTY) OVER v AS avgQty,
                  max(BSE_YW) OVER v AS maxYearWeek, min(BSE_YW) OVER v AS minYearWeek,
                  max(OFER_PRCE) OVER v AS maxPrice, min(OFER_PRCE) OVER v AS minPrice
           FROM ftr_line WINDOW v AS (PARTITION BY OFER_NR, OFER_CHNG_SEQ))
  USING (OFER_NR, OFER_CHNG_SEQ)
LEFT JOIN ftr_ofer USING (OFER_NR, OFER_CHNG_SEQ)
LEFT JOIN (SELECT OFER_NR, OFER_CHNG_SEQ, min(carrierCode) AS carrierCode,
                  count(carrierCode) AS carrierCount FROM ftr_cryr GROUP BY ALL)
  USING (OFER_NR, OFER_CHNG_SEQ)"""


# -- incremental layer ---------------------------------------------------------------

WATCHED = {
    "FTR_DEAL": "ftr_deal",
    "FTR_DEAL_LINE_ITEM": "ftr_line",
    "FTR_DEAL_CRYR": "ftr_cryr",
    "FTR_DEAL_RTE": "ftr_rte",
    "FTR_DEAL_RSLT": "ftr_deal",
}
MARKS = """
marks AS (
  SELECT tableName, maxId, maxId - maxId // 100 AS processedId
  FROM ({}))""".format(
    " UNION ALL ".join(
        f"SELECT '{name}' AS tableName, max(ID) AS maxId FROM {table}"
        for name, table in WATCHED.items()
    )
)
DELTA = " UNION ALL ".join(
    f"SELECT '{name}' AS tableName, ID, DEAL_NR, DEAL_CHNG_SEQ FROM {table} WHERE ID > "
    f"(SELECT processedId FROM marks WHERE tableName = '{name}')"
    for name, table in list(WATCHED.items())[:4]
)
CHANGED = f"""{DEALS},{MARKS},
changed AS (SELECT DISTINCT DEAL_NR, DEAL_CHNG_SEQ FROM ({DELTA})),
delta_fact AS (SELECT * FROM fact SEMI JOIN changed USING (DEAL_NR, DEAL_CHNG_SEQ)),
routes AS (SELECT DISTINCT polCode, podCode FROM delta_fact),
weeks AS (SELECT DISTINCT polCode, podCode, baseYearWeek FROM delta_fact),
in_routes AS (SELECT * FROM fact f SEMI JOIN routes r ON f.polCode IS NOT DISTINCT FROM r.polCode
              AND f.podCode IS NOT DISTINCT FROM r.podCode),
in_weeks AS (SELECT * FROM fact f SEMI JOIN weeks w ON f.polCode IS NOT DISTINCT FROM w.polCode
             AND f.podCode IS NOT DISTINCT FROM w.podCode
             AND f.baseYearWeek IS NOT DISTINCT FROM w.baseYearWeek)"""

METRICS = """
SELECT 'newDeals' AS metric, count(DISTINCT DEAL_NR) AS n FROM ftr_deal
WHERE ID > (SELECT processedId FROM marks WHERE tableName = 'FTR_DEAL')
UNION ALL SELECT 'updatedRows', count(*) FROM delta_fact
UNION ALL SELECT 'marketWatchTopics', count(*) FROM routes
UNION ALL SELECT 'weekDetailTopics', count(*) * 3 FROM weeks
UNION ALL SELECT 'dealHistoryTopics', count(*) FROM weeks"""


def _json_object(texts: list[str], numbers: list[str], *more: str) -> str:
    """JSON text of some columns; a missing value leaves its field out."""
    parts = {f: f"""'"{f}":"' || {f} || '"'""" for f in texts}
    parts |= {f: f"""'"{f}":' || {f}""" for f in numbers}
    return f"'{{' || concat_ws(',', {', '.join([*parts.values(), *more])}) || '}}'"


def _json_documents() -> str:
    cell = ", ".join(
        [
            f"""'"{f}":"' || {f} || '"'""" if f in ("baseYearWeek", "status", "latestEventDate")
            else f"""'"{f}":' || {f}"""
            for f in ("baseYearWeek", "status", "open", "low", "high", "close", "volume",
                      "changeValue", "changeRate", "latestEventDate")
        ]
    )
    cells = f"""'"Cell":[' || string_agg('{{' || concat_ws(',', {cell}) || '}}', ','
                 ORDER BY baseYearWeek NULLS FIRST) || ']'"""
    keys = ROUTE_NAMES.split(", ")
    return f"""
SELECT {_json_object(keys, [], cells)} AS value
FROM ({_sum_select('fact', '0')}) GROUP BY {ROUTE_NAMES}"""


def _json_fields(fields: str, texts: str) -> str:
    """JSON text of some columns in their order; those among ``texts`` are quoted."""
    quoted = texts.split()
    parts = [f"""'"{f}":' || '"' || {f} || '"'""" if f in quoted else f"""'"{f}":' || {f}""" for f in fields.split()]
    return f"'{{' || concat_ws(',', {', '.join(parts)}) || '}}'"


def _summary_pages(page_rows: int) -> str:
    line = _json_fields(
        "baseYearWeek dealQty dealPrice dealAmt leftQty leftPrice leftAmt lineEventTimestamp "
        "lineReferenceEventNumber lineReferenceEventChangeSeq",
        "baseYearWeek lineEventTimestamp lineReferenceEventNumber",
    )
    cell = _json_fields(
        "polCount podCount offerNumber offerChangeSeq eventTimestamp referenceEventNumber "
        "referenceEventChangeSeq allYn offerStatus carrierCount lineItem routeItem carrierItem",
        "offerNumber eventTimestamp referenceEventNumber allYn offerStatus",
    )
    document = _json_fields("userId offerTypeCode page cell", "userId offerTypeCode")
    return f""",
line_json AS (
  SELECT userId, offerTypeCode, offerNumber, offerChangeSeq, allYn,
         '[' || string_agg({line}, ',' ORDER BY baseYearWeek NULLS FIRST) || ']' AS lineItem
  FROM (SELECT DISTINCT EMP_NR AS userId, OFER_TP_CD AS offerTypeCode, OFER_NR AS offerNumber,
               OFER_CHNG_SEQ AS offerChangeSeq, ALL_YN AS allYn, BSE_YW AS baseYearWeek,
               DEAL_QTY AS dealQty, DEAL_PRCE AS dealPrice, DEAL_AMT AS dealAmt,
               OFER_REMN_QTY AS leftQty, OFER_PRCE AS leftPrice,
               CAST(CASE WHEN OFER_REMN_QTY <> 0 THEN OFER_REMN_QTY * OFER_PRCE ELSE 0 END
                    AS DECIMAL(36,4)) AS leftAmt,
               coalesce(DEAL_DT, substr(OFER_NR, 2, 21)) AS lineEventTimestamp,
               coalesce(DEAL_NR, OFER_NR) AS lineReferenceEventNumber,
               coalesce(DEAL_CHNG_SEQ, OFER_CHNG_SEQ) AS lineReferenceEventChangeSeq
        FROM latest LEFT JOIN next_deal USING (OFER_NR, OFER_CHNG_SEQ))
  GROUP BY ALL),
route_json AS (
  SELECT OFER_NR AS offerNumber, OFER_CHNG_SEQ AS offerChangeSeq,
         count(DISTINCT polCode) AS polCount, count(DISTINCT podCode) AS podCount,
         '[' || string_agg({_json_fields("polCode polName podCode podName", "polCode polName podCode podName")},
                ',' ORDER BY polCode, polName, podCode, podName) || ']' AS routeItem
  FROM (SELECT DISTINCT OFER_NR, OFER_CHNG_SEQ, polCode, polName, podCode, podName FROM rte) GROUP BY ALL),
carrier_json AS (
  SELECT OFER_NR AS offerNumber, OFER_CHNG_SEQ AS offerChangeSeq, count(DISTINCT carrierCode) AS carrierCount,
         '[' || string_agg({_json_fields("carrierCode carrierName", "carrierCode carrierName")},
                ',' ORDER BY carrierCode, carrierName) || ']' AS carrierItem
  FROM (SELECT DISTINCT OFER_NR, OFER_CHNG_SEQ, carrierCode, carrierName
        FROM ftr_cryr LEFT JOIN mdm_cryr USING (carrierCode)) GROUP BY ALL),
placed AS (
  SELECT userId, offerTypeCode, {cell} AS item, nth, CAST((nth - 1) // {page_rows} AS INTEGER) AS page
  FROM (SELECT s.* EXCLUDE (lineItem), j.lineItem, polCount, podCount, routeItem, carrierCount, carrierItem,
               row_number() OVER (PARTITION BY s.userId, s.offerTypeCode
                                  ORDER BY s.offerNumber, polCount, podCount, s.offerChangeSeq) AS nth
        FROM summary s JOIN line_json j USING (userId, offerTypeCode, offerNumber, offerChangeSeq, allYn)
        LEFT JOIN route_json USING (offerNumber, offerChangeSeq)
        LEFT JOIN carrier_json USING (offerNumber, offerChangeSeq)))
SELECT {document} AS value
FROM (SELECT userId, offerTypeCode, page, '[' || string_agg(item, ',' ORDER BY nth) || ']' AS cell
      FROM placed GROUP BY userId, offerTypeCode, page)"""


def _book_pages(page_rows: int) -> str:
    keys = (
        "marketTypeCode offerTypeCode baseYearWeek paymentTermCode rdTermCode containerTypeCode "
        "polCode podCode"
    )
    fields = (
        "tradeOfferNumber tradeOfferChangeSeq carrierCode carrierCount headPolCode headPodCode "
        "headPolName headPodName polCount podCount avgQty avgPrice allYn minYearWeek maxYearWeek "
        "maxPrice minPrice"
    )
    cell = _json_fields(
        fields,
        "tradeOfferNumber carrierCode headPolCode headPodCode headPolName headPodName allYn "
        "minYearWeek maxYearWeek",
    )
    columns = ", ".join(keys.split())
    return f"""
SELECT {_json_fields(f"{keys} page Cell", keys)} AS value
FROM (SELECT {columns}, CAST((nth - 1) // {page_rows} AS INTEGER) AS page,
             '[' || string_agg({cell}, ',' ORDER BY nth) || ']' AS Cell
      FROM (SELECT *, row_number() OVER (PARTITION BY {columns} ORDER BY tradeOfferNumber,
                   {", ".join(fields.split()[1:])}) AS nth FROM ({BOOK}))
      GROUP BY ALL)"""


def statements() -> dict[str, str]:
    deals, offers, changed = _with(DEALS), _with(OFFERS), _with(CHANGED)
    week_keys = f"{ROUTE_NAMES}, baseYearWeek"
    book_keys = (
        "marketTypeCode, offerTypeCode, baseYearWeek, paymentTermCode, rdTermCode, "
        "containerTypeCode, polCode, podCode, CAST(substr(tradeOfferNumber, 2, 6) AS INTEGER) AS page"
    )
    previous_week = f"lag(close, 1, 0) OVER (PARTITION BY {TERMS} ORDER BY baseYearWeek)"
    plain = {
        "stats_raw": f"{deals} SELECT * FROM fact",
        "stats_raw_carrier_set": f"""{changed}
SELECT d.DEAL_NR, d.DEAL_CHNG_SEQ, l.BSE_YW, d.DEAL_DT, d.offerTypeCode AS OFER_TP_CD,
       c.carrierItem, r.polCode, r.podCode, l.DEAL_AMT, l.DEAL_PRCE, l.DEAL_QTY,
       l.DEAL_PRCE AS OFER_PRCE,
       CASE WHEN l.BSE_YW IS NOT NULL THEN CAST(100 AS DECIMAL(18,2)) END AS OFER_QTY,
       CASE WHEN l.BSE_YW IS NOT NULL
            THEN CAST(greatest(100 - l.DEAL_QTY, 0) AS DECIMAL(18,2)) END AS OFER_REMN_QTY
FROM ftr_deal d
LEFT JOIN ftr_line l USING (DEAL_NR, DEAL_CHNG_SEQ)
LEFT JOIN rte r USING (DEAL_NR, DEAL_CHNG_SEQ)
LEFT JOIN (SELECT DEAL_NR, DEAL_CHNG_SEQ,
                  string_agg(carrierCode || ':' || coalesce(carrierName, '-'), ','
                             ORDER BY carrierCode) AS carrierItem
           FROM ftr_cryr LEFT JOIN mdm_cryr USING (carrierCode) GROUP BY DEAL_NR, DEAL_CHNG_SEQ) c
  USING (DEAL_NR, DEAL_CHNG_SEQ)
WHERE d.offerTypeCode = 'S'
  AND (DEAL_NR, DEAL_CHNG_SEQ) IN (SELECT (DEAL_NR, DEAL_CHNG_SEQ) FROM changed)""",
        "mw_sum_flat": f"{deals} {_sum_select('fact', '0')}",
        "mw_sum_wow": f"{deals} {_sum_select('fact', previous_week)}",
        "mw_sum_cells": deals
        + _cells(
            _sum_select("fact", "0"), ROUTE_NAMES, "latestEventDate", "baseYearWeek NULLS FIRST"
        ),
        "mw_hst_flat": f"{deals} {_history('fact')}",
        "mw_hst_cells": deals
        + _cells(_history("fact"), f"{week_keys}, 0 AS page", "timestamp", "idx"),
        "mw_wkdetail_flat": f"{deals} {_detail('fact')}",
        "mw_wkdetail_merged": f"{deals} {_detail('fact')}",
        "mw_wkdetail_cells": deals
        + _cells(_detail("fact"), f"{week_keys}, interval", "intervalTimestamp", "xAxis"),
        "mw_sum_incr": f"{changed} {_sum_select('in_routes', '0')}",
        "mw_hst_incr": changed
        + _cells(_history("in_weeks"), f"{week_keys}, 0 AS page", "priceChange", "idx"),
        "mw_wkdetail_incr": changed
        + _cells(_detail("in_weeks"), f"{week_keys}, interval", "close", "xAxis"),
        "mi_sum_flat": f"{_with(INDEX)} {_index('xAxis')}",
        "mi_sum_incr": f"{_with(INDEX)} {_index('xAxis')}",
        "mi_sum_chrono": _with(INDEX)
        + _index("CAST(substr(xAxis, 1, 4) AS INTEGER), CAST(substr(xAxis, 5) AS INTEGER)"),
        "mi_sum_cells": _with(INDEX)
        + _cells(_index("xAxis"), f"{SERIES}, interval", "xAxis", "xAxis"),
        "idx_lst": f"""{_with(INDEX, INTERVALS)}
SELECT {SERIES}, string_agg(intervalSeq || ':' || interval, ',' ORDER BY intervalSeq)
         AS intervalItem
FROM (SELECT DISTINCT {SERIES}, interval FROM ({_index('xAxis')})
      UNION ALL
      SELECT 'marketWatch', 'weekDetail', 'MWWD', 'market watch weekdetail frequencies',
             unnest(['daily', 'weekly', 'monthly']))
LEFT JOIN intervals USING (interval)
GROUP BY {SERIES}""",
        "offer_raw": f"{offers} SELECT * FROM raw",
        "offer_latest_version": f"{offers} SELECT * FROM latest",
        "offer_route_counts": f"{offers} SELECT * EXCLUDE (routeShort) FROM rtcnt",
        "offer_summary": f"""{offers}
SELECT userId, offerTypeCode, polCount, podCount, s.offerNumber, s.offerChangeSeq, eventTimestamp,
       referenceEventNumber, referenceEventChangeSeq, allYn, offerStatus, carrierCount, lineItem,
       routeShort AS routeItem, codes AS carrierItem
FROM summary s
LEFT JOIN cryr c ON c.OFER_NR = s.offerNumber AND c.OFER_CHNG_SEQ = s.offerChangeSeq
LEFT JOIN rtcnt USING (offerNumber, offerChangeSeq)""",
        "offer_summary_cells": f"""{offers}
SELECT userId, offerTypeCode, CAST(substr(offerNumber, 2, 6) AS INTEGER) AS page,
       CAST(count(*) AS INTEGER) AS cells, CAST(count(*) FILTER (offerStatus = '0') AS INTEGER) AS openCells,
       CAST(sum(lineCount) AS INTEGER) AS lineItems, max(eventTimestamp) AS lastEvent
FROM summary GROUP BY ALL""",
        "offer_summary_pages": f"{offers}{_summary_pages(100)}",
        "offer_week_detail": f"{offers} {WEEK_DETAIL}",
        "offer_week_list": f"{offers}{_week_list()}",
        "offer_route_list": f"{offers} {ROUTE_LIST}",
        **{f"offer_event_{code}": f"{offers} {_event(code)}" for code in EVENT_NAMES},
        "offer_event_log": f"{offers} {_event_log()}",
        "mw_bidask_flat": f"{offers} {BOOK}",
        "mw_bidask_pages": f"{offers} {_book_pages(100)}",
        "mw_bidask_cells": offers
        + _cells(BOOK, book_keys, "tradeOfferNumber", "tradeOfferNumber"),
        "cdc_max_id": f"{changed} SELECT tableName, maxId FROM marks",
        "cdc_lag": f"{changed} SELECT *, maxId > processedId AS advanced FROM marks",
        "cdc_gate": f"""{changed}
SELECT count(*) FILTER (maxId > processedId) AS advancedTables,
       count(*) FILTER (maxId > processedId) >= 5 AS fire FROM marks""",
        "cdc_delta": f"{changed} {DELTA}",
        "cdc_marks": f"{changed} SELECT tableName, greatest(maxId, processedId) AS maxId FROM marks",
        "cdc_topics_mw": f"{changed} SELECT * FROM routes",
        "cdc_topics_week": f"{changed} SELECT * FROM weeks",
        "cdc_metrics": f"{changed} {METRICS}",
        "upsert_by_key": f"{deals} {_sum_select('fact', '0')}",
        "json_payload": f"{deals} {_json_documents()}",
        "sample_json": f"""{deals} {_json_documents()}
HAVING CAST('0x' || substr(md5(concat_ws('|', {ROUTE_NAMES})), 1, 8) AS BIGINT) < 429496729""",
        "topic_name": f"""{deals}
SELECT DISTINCT DEAL_NR, '/topic/01_01_01_' || polCode || '_' || podCode || '_01' AS topic
FROM rte""",
    }
    # A refresh or an added part gives what a full build gives.
    refreshed = ["offer_summary", "offer_week_list", "offer_route_list", "offer_week_detail", "offer_event_log"]
    return plain | {
        **{f"{name}_refresh": plain[name] for name in refreshed},
        "offer_raw_append": plain["offer_raw"],
        "mi_sum_refresh": plain["mi_sum_flat"],
    }

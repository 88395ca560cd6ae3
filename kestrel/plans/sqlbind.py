"""SQL text of the canonical inputs (mirror of ``kestrel.sources.bindings``),
used to build the DuckDB oracle queries.  Each constant is a CTE body list
item: ``name AS (...)``."""

PANEL_M = """panel_m AS (
  SELECT l_suppkey AS id, CAST(date_trunc('month', l_shipdate) AS DATE) AS d,
         avg(l_extendedprice) AS price, sum(l_quantity) AS vol
  FROM lineitem GROUP BY 1, 2)"""

PANEL_R = """panel_r AS (
  SELECT id, d, price, vol,
         price / nullif(lag(price) OVER (PARTITION BY id ORDER BY d), 0) - 1 AS ret
  FROM panel_m)"""

PANEL_S = """panel_s AS (
  SELECT *, price / nullif(lag(price) OVER w, 0) - 1 AS ret, price_net / nullif(lag(price_net) OVER w, 0) - 1 AS retx
  FROM (SELECT l_suppkey AS id, CAST(date_trunc('month', l_shipdate) AS DATE) AS d, avg(l_extendedprice) AS price,
               sum(l_quantity) AS vol, avg(l_extendedprice * (1 - l_discount)) AS price_net FROM lineitem GROUP BY 1, 2) AS _m
  WINDOW w AS (PARTITION BY id ORDER BY d))"""

CAL = """cal AS (
  SELECT d, row_number() OVER (ORDER BY d) AS date_idx FROM (SELECT DISTINCT d FROM panel_r) AS _d)"""

PR = """pr AS (SELECT p.id, p.d, p.price, p.vol, p.ret, c.date_idx FROM panel_r p JOIN cal c USING (d))"""

# contrarian weights with lag-1 excess (NULL excess -> NULL weight)
MKT = """mkt AS (SELECT d, avg(ret) AS mkt FROM pr GROUP BY d)"""
EX = """ex AS (SELECT pr.*, mkt.mkt, ret - mkt.mkt AS excess FROM pr JOIN mkt USING (d))"""
W1 = """raw1 AS (SELECT id, d, date_idx, -excess AS raw FROM ex),
sums1 AS (SELECT d, sum(CASE WHEN raw > 0 THEN raw END) AS lsum,
                 sum(CASE WHEN raw < 0 THEN -raw END) AS ssum FROM raw1 GROUP BY d),
w1 AS (SELECT id, d, date_idx,
              CASE WHEN raw > 0 THEN raw / lsum WHEN raw < 0 THEN raw / ssum ELSE raw END AS w
       FROM raw1 JOIN sums1 USING (d))"""
PI1 = """prod1 AS (SELECT r.date_idx, sum(w1.w * r.ret) AS pi
          FROM w1 JOIN pr r ON r.id = w1.id AND r.date_idx = w1.date_idx + 1 GROUP BY r.date_idx),
pi1 AS (SELECT c.d, c.date_idx, coalesce(prod1.pi, 0.0) AS pi FROM cal c LEFT JOIN prod1 USING (date_idx))"""

PANEL_D = """panel_d AS (
  SELECT CAST(l_shipdate AS DATE) AS d, l_suppkey AS id, (l_quantity - 26.0) / 20.0 AS ret,
         CASE WHEN l_partkey % 17 <> 0 THEN l_extendedprice / l_quantity END AS price,
         CASE WHEN l_partkey % 13 <> 0 THEN l_quantity ELSE 0.0 END AS volume,
         l_orderkey AS okey, l_linenumber AS lnum
  FROM lineitem)"""

LEGS = """legs AS (
  SELECT l_returnflag AS instrument, CAST(l_shipdate AS DATE) AS d, avg(l_extendedprice) AS px
  FROM lineitem GROUP BY 1, 2)"""

LEGS_M = """legs_m AS (
  SELECT l_returnflag AS instrument, CAST(date_trunc('month', l_shipdate) AS DATE) AS d,
         avg(l_extendedprice) AS px
  FROM lineitem GROUP BY 1, 2)"""

PRIO_REV = """prio_rev AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS d,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio, sum(o_totalprice) AS rev
  FROM orders GROUP BY 1, 2)"""

FACTORS = """fwide AS (
  SELECT d, sum(rev) AS r_all,
         sum(CASE WHEN prio = 1 THEN rev END) AS r1, sum(CASE WHEN prio = 2 THEN rev END) AS r2,
         sum(CASE WHEN prio = 3 THEN rev END) AS r3, sum(CASE WHEN prio = 4 THEN rev END) AS r4,
         sum(CASE WHEN prio = 5 THEN rev END) AS r5
  FROM prio_rev GROUP BY d),
factors AS (
  SELECT * FROM (
    SELECT d,
      ln(r_all) - lag(ln(r_all)) OVER (ORDER BY d) AS mktrf,
      (ln(r1) - lag(ln(r1)) OVER (ORDER BY d)) - (ln(r2) - lag(ln(r2)) OVER (ORDER BY d)) AS smb,
      (ln(r3) - lag(ln(r3)) OVER (ORDER BY d)) - (ln(r4) - lag(ln(r4)) OVER (ORDER BY d)) AS hml,
      (ln(r5) - lag(ln(r5)) OVER (ORDER BY d)) - (ln(r_all) - lag(ln(r_all)) OVER (ORDER BY d)) AS umd,
      0.0 AS rf
    FROM fwide) AS _f
  WHERE mktrf IS NOT NULL)"""

NATION_SERIES = """nseries AS (
  SELECT CAST(c_nationkey AS BIGINT) AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS t,
         sum(o_totalprice) AS y
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""

EVENT_SERIES = """eseries AS (
  SELECT event_type AS series_id, CAST(ts AS DATE) AS t, sum(value) AS y FROM events GROUP BY 1, 2)"""

TAXONOMY = """edges AS (
  SELECT DISTINCT 'Root' AS parent, lang AS child FROM documents
  UNION ALL
  SELECT DISTINCT lang AS parent, lang || '/' || source AS child FROM documents)"""

LABELS_LONG = """labels_long AS (
  SELECT doc_id AS id, lang AS cat FROM documents
  UNION ALL
  SELECT doc_id AS id, lang || '/' || source AS cat FROM documents WHERE doc_id % 7 <> 0
  UNION ALL
  SELECT doc_id AS id, 'misc' AS cat FROM documents WHERE doc_id % 11 = 0)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

PANEL_Q = """panel_q AS (
  SELECT id, d, price,
         price / nullif(lag(price) OVER (PARTITION BY id ORDER BY d), 0) - 1
           + CASE WHEN id % 4 = 0 THEN 0.0 ELSE 0.001 END AS prc,
         price * vol / 1000.0 AS mcap
  FROM (SELECT id, d, CASE WHEN (id + year(d) * 12 + month(d)) % 29 <> 0 THEN price END AS price, vol
        FROM panel_m) AS _m)"""

LEG_RET = """leg_ret AS (
  SELECT instrument, d, px, px / nullif(lag(px) OVER (PARTITION BY instrument ORDER BY d), 0) - 1 AS ret FROM legs)"""

PAIR_RET = """pair_ret AS (
  SELECT a.instrument || '-' || b.instrument AS pair, a.d, a.ret AS ret_a, b.ret AS ret_b
  FROM leg_ret a JOIN leg_ret b ON a.d = b.d
  WHERE (a.instrument, b.instrument) IN (('A', 'N'), ('A', 'R'), ('N', 'R'))
    AND a.ret IS NOT NULL AND b.ret IS NOT NULL)"""

DID = """did AS (
  SELECT c_custkey AS store, CAST(n_regionkey = 0 AS INTEGER) AS nj, c_mktsegment AS chain,
         CAST(c_custkey % 3 = 0 AS INTEGER) AS co_owned,
         CAST(coalesce(p.fte, 0) AS DOUBLE) AS fte, CAST(coalesce(p.fte2, 0) AS DOUBLE) AS fte2,
         CASE WHEN n_regionkey = 0 THEN greatest(0.0, (5000.0 - c_acctbal) / 10000.0) ELSE 0.0 END AS gap,
         CASE WHEN coalesce(p.fte2, 0) = 0 THEN 1 ELSE 0 END AS closed
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT o_custkey, count(CASE WHEN o_orderdate < TIMESTAMP '1998-07-01' THEN 1 END) AS fte,
                    count(CASE WHEN o_orderdate >= TIMESTAMP '1998-07-01' THEN 1 END) AS fte2
             FROM orders GROUP BY o_custkey) p ON c_custkey = p.o_custkey)"""

# closure of the taxonomy: (ancestor, descendant, dist), self included
CLOSURE = """nodes AS (SELECT parent AS node FROM edges UNION SELECT child FROM edges),
closure AS (
  SELECT node AS ancestor, node AS descendant, 0 AS dist FROM nodes
  UNION ALL
  SELECT c.ancestor, e.child, c.dist + 1 FROM closure c JOIN edges e ON e.parent = c.descendant),
depth AS (SELECT descendant AS node, dist AS depth FROM closure WHERE ancestor = 'Root')"""


def with_rec(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"

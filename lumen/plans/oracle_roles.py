"""The role tables written as SQL common table expressions (DuckDB dialect).

These are the independent oracle's view of FIXTURES.md §2; they must give the
same rows as ``lumen.plans.roles`` on the provided tables.
"""

TRIPS = """trips AS (
  SELECT CAST(year(CAST(l.l_shipdate AS DATE)) AS INTEGER) AS year,
         CAST(month(CAST(l.l_shipdate AS DATE)) AS INTEGER) AS month,
         CAST(day(CAST(l.l_shipdate AS DATE)) AS INTEGER) AS day,
         CAST(l.l_shipdate AS DATE) AS flight_date,
         l.l_orderkey AS flight,
         l.l_suppkey AS dest,
         CASE WHEN l.l_orderkey % 41 <> 0 THEN CAST(l.l_quantity - 25 AS INTEGER) END AS dep_delay,
         CAST(l.l_quantity AS INTEGER) AS air_time,
         l.l_linenumber AS leg,
         l.l_partkey AS part_key,
         l.l_extendedprice AS fare,
         o.o_orderpriority AS carrier,
         CASE WHEN l.l_orderkey % 37 <> 0
              THEN CAST(CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE) AS INTEGER) END AS arr_delay
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

AIRPORTS = """airports AS (SELECT s_suppkey AS faa, s_name AS name FROM supplier)"""

AIRLINES = """airlines AS (SELECT n_nationkey AS carrier_code, n_name AS name FROM nation)"""

SUPPLIER_AIRLINE = """supplier_airline AS (SELECT s_suppkey AS dest, s_nationkey AS carrier_code FROM supplier)"""

DIAMONDS = """diamonds AS (
  SELECT p_partkey AS diamond_id, p_type AS cut, p_brand AS color, p_name AS clarity,
         p_size AS carat, p_retailprice AS price FROM part)"""

USARRESTS = """usarrests AS (
  SELECT c_name AS state, c_acctbal AS Murder, c_nationkey AS Assault, c_custkey AS UrbanPop
  FROM customer)"""

IRIS = """iris AS (
  SELECT vec_id AS iris_id,
         CAST(embedding[1] AS DOUBLE) AS sepal_length,
         CAST(embedding[2] AS DOUBLE) AS sepal_width,
         CAST(embedding[3] AS DOUBLE) AS petal_length,
         CAST(embedding[4] AS DOUBLE) AS petal_width,
         label AS species
  FROM embeddings)"""

EVENTS = """ev AS (
  SELECT event_id, user_id, event_type AS carrier, CAST(hour(ts) AS INTEGER) AS hour,
         CAST(ts AS DATE) AS day,
         CASE WHEN event_id % 37 <> 0 THEN value END AS value
  FROM events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

"""Common table expressions of the checking SQL."""

ORDER_VALUE = """obs AS (
  SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS as_of,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders GROUP BY 1, 2)"""

ORDER_VALUE_TOTAL = """total AS (
  SELECT 'orders_total' AS series_id, CAST(o_orderdate AS DATE) AS as_of,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders GROUP BY 2)"""


def friday(day: str) -> str:
    return f"({day} + CAST((12 - isodow({day})) % 7 AS INTEGER))"


WEEKLY = f"""weekly AS (
  SELECT series_id, {friday('as_of')} AS as_of, arg_max(value, as_of) AS value
  FROM obs WHERE value IS NOT NULL GROUP BY 1, 2)"""

MONTHLY = """monthly AS (
  SELECT series_id, last_day(as_of) AS as_of,
         AVG(value) AS value
  FROM obs GROUP BY 1, 2)"""

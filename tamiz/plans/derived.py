"""The lead relation derived from customers and their latest order, in both SQL dialects.

Plain integer arithmetic over keys, so that each engine evaluates the same rows; the rules stand here once. The id is the
customer's key, which is unique, so no global numbering is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUTOFF = "2001-08-01"

_RULES = """
SELECT k AS id_fila,
  CASE WHEN k % 37 = 0 THEN '' WHEN k % 41 = 0 THEN 'test' ELSE c_name END AS nombre,
  CASE WHEN p = '' THEN '' WHEN k % 2 = 0 THEN p || '-' || dni || '-' || dv ELSE p || dni || dv END AS cuil,
  CASE k % 10 WHEN 0 THEN '+54 9 11 ' || p1 || ' ' || p2 WHEN 1 THEN '+54911' || p1 || p2 WHEN 2 THEN '011-' || p1 || p2
    WHEN 3 THEN '(011) ' || p1 || '-' || p2 WHEN 4 THEN '11' || p1 || p2 WHEN 5 THEN '54911' || p1 || p2 WHEN 6 THEN '11 15 ' || p1 || ' ' || p2
    WHEN 7 THEN '15-' || p1 || '-' || p2 WHEN 8 THEN 'sin dato' ELSE '1111111111' END AS telefono,
  CASE n % 12 WHEN 0 THEN 'Castelar' WHEN 1 THEN 'HAEDO' WHEN 2 THEN 'Morón' WHEN 3 THEN ' hurlingham ' WHEN 4 THEN 'Ituzaingó (Buenos Aires)'
    WHEN 5 THEN 'Ramos Mejía, Buenos Aires' WHEN 6 THEN 'Villa  Luzuriaga' WHEN 7 THEN 'San Justo' WHEN 8 THEN 'Merlo' WHEN 9 THEN 'Moreno'
    WHEN 10 THEN '' ELSE 'moron' END AS localidad,
  CASE seg WHEN 'BUILDING' THEN 'referido' WHEN 'AUTOMOBILE' THEN 'formulario web' WHEN 'MACHINERY' THEN 'evento' WHEN 'HOUSEHOLD' THEN 'campaña Meta'
    WHEN 'FURNITURE' THEN 'base propia' ELSE 'otro' END AS origen,
  CASE WHEN k % 17 = 0 OR d IS NULL THEN '' WHEN k % 19 = 0 THEN '2026-13-45' WHEN k % 11 = 0 THEN {dmy} ELSE {iso} END AS fecha_carga
FROM (
  SELECT *, substr(line, 1, 4) AS p1, substr(line, 5, 4) AS p2,
    CAST(CASE WHEN k % 13 = 0 THEN (right_dv + 1) % 10 ELSE right_dv END AS {text}) AS dv
  FROM (
    SELECT *, CASE WHEN r = 0 THEN 0 WHEN r = 1 THEN 9 ELSE 11 - r END AS right_dv
    FROM (
      SELECT *, ({sum}) % 11 AS r
      FROM (
        SELECT k, c_name, n, seg, d, CAST(40000000 + (half3 * 97) % 10000000 AS {text}) AS line, CAST(30000000 + half2 * 7 AS {text}) AS dni,
          CASE half2 % 9 WHEN 0 THEN '20' WHEN 1 THEN '23' WHEN 2 THEN '24' WHEN 3 THEN '27' WHEN 4 THEN '30' WHEN 5 THEN '33' WHEN 6 THEN '34' WHEN 7 THEN '99' ELSE '' END AS p
        FROM (
          SELECT c.c_custkey AS k, c.c_name, c.c_nationkey AS n, c.c_mktsegment AS seg, o.d,
            CAST(floor(c.c_custkey / 3) AS BIGINT) AS half3, CAST(floor(c.c_custkey / 2) AS BIGINT) AS half2
          FROM {customer} c LEFT JOIN (SELECT o_custkey AS ok, max(o_orderdate) AS d FROM {orders} GROUP BY o_custkey) o ON o.ok = c.c_custkey
        ) keys
      ) parts
    ) sums
  ) digits
) leads_source
"""

# Weights of the check digit.
_WEIGHTS = (5, 4, 3, 2, 7, 6, 5, 4, 3, 2)


def _text(text: str, iso: str, dmy: str, customer: str = "customer", orders: str = "orders") -> str:
    digits = [f"CAST(substr(CASE WHEN p = '' THEN '00' ELSE p END || dni, {i + 1}, 1) AS INT) * {w}" for i, w in enumerate(_WEIGHTS)]
    return _RULES.format(text=text, iso=iso, dmy=dmy, sum=" + ".join(digits), customer=customer, orders=orders)


def oracle_leads() -> str:
    return _text("VARCHAR", "strftime(d, '%Y-%m-%d')", "strftime(d, '%d/%m/%Y')")


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderdate")
    q = _text("STRING", "date_format(d, 'yyyy-MM-dd')", "date_format(d, 'dd/MM/yyyy')", "{c}", "{o}")
    df = spark.sql(q, c=c, o=o)
    # The rules are deep; evaluated once here, later filters don't drag copies of them along.
    return df.select(F.inline(F.array(F.struct(*df.columns))))

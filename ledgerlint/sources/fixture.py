"""The dirty transaction table used as test input, derived from the TPC-H-like tables.

The same SQL text runs in Spark (with the tables bound as DataFrames) and in
DuckDB (as the oracle's first CTE), so both sides start from identical rows.
Every row of ``orders`` yields one dirty row; values cycle through clean,
padded, malformed and missing forms by the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import limit_generated_methods

FIXTURE_SQL = """
WITH b AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS p, c_acctbal AS bal, n_name AS nn,
         lpad(CAST(o_orderkey AS STRING), 8, '0') AS kid, lpad(CAST(o_custkey AS STRING), 8, '0') AS cid,
         CAST(year(o_orderdate) AS STRING) AS y,
         lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS m,
         lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS d
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
)
SELECT
  k AS src_row,
  CASE WHEN k % 50 = 0 THEN NULL WHEN k % 37 = 0 THEN 'ID-12' ELSE 'ID-' || cid END AS customer_id,
  CASE k % 8 WHEN 0 THEN 'John' WHEN 1 THEN ' Mary ' WHEN 2 THEN 'null' WHEN 3 THEN 'FName' WHEN 4 THEN 'J0hn' WHEN 5 THEN NULL WHEN 6 THEN 'Ana' ELSE 'robert' END AS first_name,
  CASE k % 7 WHEN 0 THEN 'Smith' WHEN 1 THEN 'Dash-Name' WHEN 2 THEN 'lastname' WHEN 3 THEN 'Lee' WHEN 4 THEN NULL WHEN 5 THEN 'Garcia' ELSE 'LName' END AS last_name,
  CASE k % 11 WHEN 0 THEN 'John Smith' WHEN 1 THEN 'Smith, John Jr.' WHEN 2 THEN 'JOHN X ana LEE sr jr' WHEN 3 THEN 'Ana-Lee' WHEN 4 THEN 'firstname lastname' WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN 'Dr. Ana Garcia Sr' WHEN 8 THEN 'Jr John Lee' WHEN 9 THEN 'Xyz Qqq' ELSE 'John Jr' END AS full_name,
  CASE k % 9 WHEN 0 THEN 'M' WHEN 1 THEN ' female ' WHEN 2 THEN 'F' WHEN 3 THEN 'male' WHEN 4 THEN 'nb' WHEN 5 THEN 'unknown' WHEN 6 THEN NULL WHEN 7 THEN '' ELSE 'zzz' END AS gender,
  CASE k % 16 WHEN 0 THEN y || m || d || '103059' WHEN 1 THEN y || '-' || m || '-' || d WHEN 2 THEN y || '/' || m || '/' || d WHEN 3 THEN m || '/' || d || '/' || y WHEN 4 THEN m || '/' || d || '/' || y || ' 10:30' WHEN 5 THEN y || '/' || m || '/' || d || ' 23:59' WHEN 6 THEN d || '-Jan-99' WHEN 7 THEN d || '-JAN-68' WHEN 8 THEN d || '-Mar-' || y WHEN 9 THEN 'Dec-' || d || '-' || y WHEN 10 THEN 'Aug ' || d || ' ' || y WHEN 11 THEN y WHEN 12 THEN '5 March ' || y WHEN 13 THEN ' January 5, ' || y || ' ' WHEN 14 THEN '31/31/2020' ELSE NULL END AS dob,
  CASE k % 8 WHEN 0 THEN '42' WHEN 1 THEN ' 17 ' WHEN 2 THEN '-3' WHEN 3 THEN '121' WHEN 4 THEN 'abc' WHEN 5 THEN NULL WHEN 6 THEN '42.0' ELSE '0' END AS age,
  CASE k % 6 WHEN 0 THEN 'u' || cid || '@mail.com' WHEN 1 THEN ' a.b+c@x-y.co.uk ' WHEN 2 THEN 'bad@' WHEN 3 THEN 'no-at.com' WHEN 4 THEN NULL ELSE 'a b@c.com' END AS email,
  CASE k % 6 WHEN 0 THEN '(555) 123-4567' WHEN 1 THEN '5551234567' WHEN 2 THEN '+1 555 123 4567' WHEN 3 THEN '123' WHEN 4 THEN NULL ELSE '555.987.6543' END AS phone,
  CASE k % 5 WHEN 0 THEN '  12 main st, apt #4b!  ' WHEN 1 THEN '99 OAK-AVE.' WHEN 2 THEN NULL WHEN 3 THEN '' ELSE lower(nn) || ' road' END AS address,
  CASE k % 4 WHEN 0 THEN ' new york1 ' WHEN 1 THEN 'LOS ANGELES' WHEN 2 THEN NULL ELSE 'st. louis' END AS city,
  CASE k % 7 WHEN 0 THEN 'CA' WHEN 1 THEN 'texas' WHEN 2 THEN 'ny' WHEN 3 THEN ' WA' WHEN 4 THEN NULL WHEN 5 THEN 'DC' ELSE 'North Carolina' END AS state,
  CASE k % 6 WHEN 0 THEN '12345' WHEN 1 THEN '12345-6789' WHEN 2 THEN '123' WHEN 3 THEN '' WHEN 4 THEN NULL ELSE 'zip 98 765' END AS zip_code,
  CASE k % 7 WHEN 0 THEN '720' WHEN 1 THEN '720.5' WHEN 2 THEN '5' WHEN 3 THEN 'score: 299' WHEN 4 THEN NULL WHEN 5 THEN '851' ELSE '' END AS credit_score,
  CASE k % 6 WHEN 0 THEN '$' || CAST(50000 + (k * 7919) % 90000 AS STRING) WHEN 1 THEN '1,234.50' WHEN 2 THEN '-300' WHEN 3 THEN 'n/a' WHEN 4 THEN NULL ELSE '1.2.3' END AS annual_income,
  CASE k % 8 WHEN 0 THEN 'EMPLOYED' WHEN 1 THEN ' part-time ' WHEN 2 THEN 'Self-Employed' WHEN 3 THEN 'freelance' WHEN 4 THEN NULL WHEN 5 THEN 'full-time' WHEN 6 THEN 'Retired' ELSE 'unknown' END AS employment_status,
  CASE WHEN k % 53 = 0 THEN '2999-01-01' WHEN k % 3 = 0 THEN y || '-' || m || '-' || d WHEN k % 3 = 1 THEN m || '/' || d || '/' || y ELSE NULL END AS account_open_date,
  CASE k % 7 WHEN 0 THEN 'checking' WHEN 1 THEN 'Savings' WHEN 2 THEN 'Retail' WHEN 3 THEN 'Online' WHEN 4 THEN 'CHK' WHEN 5 THEN NULL ELSE 'retail' END AS account_type,
  CASE k % 5 WHEN 0 THEN '-20000.75' WHEN 1 THEN '$10,000,001.00' WHEN 2 THEN NULL WHEN 3 THEN '.5' ELSE '.' END AS account_balance,
  CASE WHEN k % 41 = 0 THEN 'X-1' ELSE 'ID-' || kid END AS transaction_id,
  CASE WHEN k % 59 = 0 THEN '1850-01-01' WHEN k % 4 = 0 THEN y || '/' || m || '/' || d || ' 08:00' WHEN k % 4 = 1 THEN m || '/' || d || '/' || y || ' 08:00' WHEN k % 4 = 2 THEN y || m || d || '000000' ELSE y || '-' || m || '-' || d END AS transaction_date,
  CASE k % 6 WHEN 0 THEN '$' || CAST(k % 20000 AS STRING) || '.25' WHEN 1 THEN '250000' WHEN 2 THEN '0.5' WHEN 3 THEN '-12.00 USD' WHEN 4 THEN NULL ELSE 'free' END AS transaction_amount,
  CASE k % 8 WHEN 0 THEN 'W/D' WHEN 1 THEN ' DEP ' WHEN 2 THEN 'PUR' WHEN 3 THEN 'XFR' WHEN 4 THEN 'Payment' WHEN 5 THEN 'payment' WHEN 6 THEN NULL ELSE 'W' END AS transaction_type,
  CASE k % 8 WHEN 0 THEN 'acme, inc.' WHEN 1 THEN 'Inc' WHEN 2 THEN '3m   company' WHEN 3 THEN '!!!' WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'co foo LLC' ELSE 'null' END AS merchant_name,
  CASE k % 6 WHEN 0 THEN ' travel' WHEN 1 THEN '"GAS"' WHEN 2 THEN 'd1ning' WHEN 3 THEN 'Dining*' WHEN 4 THEN NULL ELSE 'pets' END AS merchant_category,
  CASE k % 8 WHEN 0 THEN 'cc' WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'D.C.' WHEN 3 THEN 'chk' WHEN 4 THEN 'ACH' WHEN 5 THEN NULL WHEN 6 THEN 'null' ELSE 'check' END AS payment_method,
  CASE k % 6 WHEN 0 THEN '0042' WHEN 1 THEN '42' WHEN 2 THEN '4111-1111-1111-1234' WHEN 3 THEN 'none' WHEN 4 THEN NULL ELSE '9876.0' END AS card_last_four,
  CASE k % 8 WHEN 0 THEN 'AMEX' WHEN 1 THEN 'vISA' WHEN 2 THEN ' MC ' WHEN 3 THEN 'DIS' WHEN 4 THEN '  ' WHEN 5 THEN NULL WHEN 6 THEN 'N/A' ELSE 'Visa' END AS card_type,
  CASE k % 7 WHEN 0 THEN 'Y' WHEN 1 THEN 'no' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'f' WHEN 4 THEN NULL WHEN 5 THEN '1' ELSE ' yes' END AS is_fraud,
  CASE k % 7 WHEN 0 THEN 'true' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN '0' WHEN 4 THEN NULL WHEN 5 THEN 'maybe' ELSE 'Y' END AS is_flagged,
  CASE k % 5 WHEN 0 THEN '0.85' WHEN 1 THEN '1.5' WHEN 2 THEN NULL WHEN 3 THEN '-0.2' ELSE 'high' END AS risk_score,
  CASE k % 3 WHEN 0 THEN ' VIP: call back!! ' WHEN 1 THEN NULL ELSE '' END AS notes,
  CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN 'a_b-c' ELSE 'Ok' END AS internal_comments,
  CASE k % 4 WHEN 0 THEN 'L-' || kid WHEN 1 THEN ' ID-' || kid || ' ' WHEN 2 THEN 'legacy' ELSE NULL END AS legacy_id,
  'x' AS unused_field,
  CASE WHEN k % 2 = 0 THEN 'tmp' ELSE NULL END AS temp_data
FROM b
"""


def fixture_sql(orders: str = "orders", customer: str = "customer", nation: str = "nation") -> str:
    """The fixture SQL with concrete table names (for DuckDB or SQL views)."""
    return FIXTURE_SQL.format(orders=orders, customer=customer, nation=nation)


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dirty, all-text transaction row per order of ``sf_dir``."""
    limit_generated_methods(spark)
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    # One dirty row is ~40 text columns built from 3 narrow order columns: the narrow rows are dealt
    # out first, at any size, so that a file of one split does not build all wide rows in one task.
    orders = read("orders").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    return spark.sql(FIXTURE_SQL, orders=orders, customer=read("customer"), nation=read("nation"))

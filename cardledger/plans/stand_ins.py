"""Card-loyalty test inputs derived from the given tables.

The texts run unchanged in Spark SQL and in DuckDB.  They describe input, not
the engine: Spark builds them as views, the oracle statements carry them as
common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BASE_TABLES = ("customer", "orders", "events")

VIEWS: dict[str, str] = {}

VIEWS["fx_master"] = """
SELECT CASE WHEN c_custkey % 20 = 7 THEN '18210' ELSE '18200' END AS product_company,
       lpad(CAST(CAST(floor(c_custkey / 2) AS BIGINT) AS STRING), 15, '0') AS customer_number,
       lpad(CAST(c_custkey AS STRING), 23, '0') AS account_number,
       CASE WHEN c_custkey % 50 = 3 THEN NULL ELSE c_acctbal >= 0 END AS is_customer_number_active,
       c_name AS customer_name, c_mktsegment AS customer_status
FROM customer WHERE c_custkey % 10 <> 0"""

VIEWS["fx_balance"] = """
SELECT product_company, customer_number,
       CAST(CASE WHEN min(account_number) LIKE '%8' THEN NULL ELSE 100 END AS DECIMAL(18,3)) AS balance_virtualcredit,
       CAST(50 AS DECIMAL(18,3)) AS balance_extrabonus
FROM fx_master GROUP BY product_company, customer_number"""

VIEWS["fx_feed"] = """
SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'XXX' ELSE 'CHP' END AS appcode,
       CASE WHEN o_custkey % 20 = 7 THEN '18210' ELSE '18200' END AS product_company,
       lpad(CAST(o_custkey AS STRING), 23, '0') AS account_number,
       lpad(CAST(CAST(floor(o_custkey / 2) AS BIGINT) AS STRING), 15, '0') AS customer_number,
       lpad(CAST(o_orderkey AS STRING), 12, '0') AS transaction_id,
       replace(substring(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 10), '-', '') AS transaction_date,
       CASE o_orderstatus WHEN 'F' THEN 'VC' WHEN 'O' THEN 'E' ELSE 'ZZ' END AS transaction_type,
       CASE WHEN o_orderkey % 4 = 0 THEN '-' ELSE '+' END AS sign,
       'EUR' AS currency,
       CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) AS value,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'QQ' WHEN o_orderpriority = '2-HIGH' THEN 'BB' ELSE 'DA' END AS causalcode,
       concat('FEED_', CAST(o_orderkey % 7 AS STRING), '.csv') AS input_filename,
       '20240101000000' AS input_filename_timestamp
FROM orders"""

VIEWS["fx_history"] = """
SELECT * FROM fx_feed WHERE CAST(transaction_id AS BIGINT) % 3 = 0"""

VIEWS["fx_eav"] = """
SELECT event_id AS line_no, lpad(CAST(user_id AS STRING), 23, '0') AS key_id,
       CASE event_type WHEN 'click' THEN 'X11422C2' WHEN 'view' THEN 'X11422PG' WHEN 'purchase' THEN 'X1142289'
                       WHEN 'signup' THEN 'X1142278' ELSE 'X1142234' END AS alias,
       CASE WHEN event_id % 3 = 0 THEN 'C' ELSE 'A' END AS maint_type,
       CASE event_id % 5 WHEN 0 THEN 'AA' WHEN 1 THEN 'KK' WHEN 2 THEN 'DD' WHEN 3 THEN '' ELSE 'ZZ' END AS old_value,
       CASE event_id % 8 WHEN 0 THEN 'KK' WHEN 1 THEN 'CB' WHEN 2 THEN 'CT' WHEN 3 THEN 'GD'
                         WHEN 4 THEN 'KD' WHEN 5 THEN 'JD' WHEN 6 THEN 'DD' ELSE 'AA' END AS new_value
FROM events"""

VIEWS["fx_transition"] = """
SELECT key_id AS account_number, line_no, old_value AS plastic_status_old, new_value AS plastic_status_new FROM fx_eav"""

VIEWS["fx_overpunch"] = """
SELECT o_orderkey,
       concat(lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING), 14, '0'),
              CASE WHEN o_orderkey % 97 = 0 THEN '?'
                   WHEN o_orderkey % 4 = 0 THEN substring('èJKLMNOPQR', CAST(o_orderkey % 10 AS INT) + 1, 1)
                   ELSE substring('àABCDEFGHI', CAST(o_orderkey % 10 AS INT) + 1, 1) END) AS raw
FROM orders"""

VIEWS["fx_fixed"] = """
SELECT o.o_orderkey,
       concat('26', CASE WHEN o.o_custkey % 20 = 7 THEN '18210' ELSE '18200' END, rpad('', 15, ' '), 'PGM01', rpad('', 15, ' '),
              lpad(CAST(o.o_custkey AS STRING), 23, '0'), lpad(CAST(o.o_orderkey AS STRING), 23, '0'),
              CASE WHEN substring(CAST(CAST(o.o_orderdate AS DATE) AS STRING), 1, 2) = '19' THEN '0' ELSE '1' END, substring(replace(substring(CAST(CAST(o.o_orderdate AS DATE) AS STRING), 1, 10), '-', ''), 3, 6),
              p.raw, 'GT', CASE WHEN o.o_orderkey % 5 = 0 THEN '840' WHEN o.o_orderkey % 5 = 1 THEN '000' ELSE '978' END,
              lpad('0', 15, '0'), p.raw, lpad('0', 16, '0'), '1240101') AS line
FROM orders o JOIN fx_overpunch p ON o.o_orderkey = p.o_orderkey"""

VIEWS["fx_stated_total"] = """
SELECT account_number,
       CAST(sum(CAST(concat(sign, value) AS BIGINT)) + CASE WHEN CAST(account_number AS BIGINT) % 13 = 0 THEN 1 ELSE 0 END AS BIGINT) AS stated_total
FROM fx_feed GROUP BY account_number"""

VIEWS["fx_loaded"] = """
SELECT DISTINCT input_filename FROM fx_feed WHERE input_filename IN ('FEED_0.csv', 'FEED_3.csv')"""

# ---- full shapes of the stored tables -------------------------------------

# The feed with the columns it lacks; every eleventh causal text holds a delimiter.
VIEWS["fx_movement"] = """
SELECT appcode, product_company, customer_number, account_number, transaction_id, transaction_date,
       'PGM01' AS loyalty_program_cod, CAST(CAST(value AS BIGINT) AS DECIMAL(15,2)) AS transaction_value,
       transaction_type, sign, currency, value,
       CASE WHEN CAST(transaction_id AS BIGINT) % 11 = 0 THEN 'bonus; spring' ELSE 'bonus' END AS causal,
       causalcode, input_filename, input_filename_timestamp, '20240202101500' AS elaboration_ts,
       concat('2024010', CAST(CAST(transaction_id AS BIGINT) % 7 + 1 AS STRING), '0000000') AS internallog_ts
FROM fx_feed"""

# Partner movements of which every 17th has a value that is no number.
VIEWS["fx_partner"] = """
SELECT appcode, product_company, customer_number, account_number, transaction_id, transaction_date, loyalty_program_cod,
       transaction_value, transaction_type, sign, currency,
       CASE WHEN CAST(transaction_id AS BIGINT) % 17 = 0 THEN 'n/a' ELSE value END AS value,
       causal, causalcode, input_filename, input_filename_timestamp, elaboration_ts, internallog_ts
FROM fx_movement"""

# Load log by name and by header timestamp: files 0 and 3 by name, file 5 by its timestamp.
VIEWS["fx_loaded_log"] = """
SELECT input_filename, CAST(NULL AS STRING) AS internallog_ts FROM fx_loaded
UNION ALL
SELECT DISTINCT 'OTHER.csv' AS input_filename, internallog_ts FROM fx_movement WHERE internallog_ts = '202401060000000'"""

# History as the ledger holds it: rewritten ids, half of them from another file.
VIEWS["fx_ledger"] = """
SELECT product_company, customer_number,
       concat(appcode, transaction_id, '_', transaction_date, '_', file_ts) AS transaction_id,
       transaction_date, file_ts AS input_filename_timestamp
FROM (SELECT *, CASE WHEN CAST(transaction_id AS BIGINT) % 2 = 0 THEN '20231201000000' ELSE input_filename_timestamp END AS file_ts
      FROM fx_history) h"""

VIEWS["fx_anag"] = """
SELECT 'CAMS' AS appcode, '' AS issuer_id, product_company AS customer_company, product_company, customer_number,
       account_number, is_customer_number_active, is_customer_number_active AS is_account_number_active,
       customer_status, customer_status AS account_status, customer_name,
       concat('S', substring(account_number, 18, 6)) AS customer_surname,
       concat('Via ', substring(account_number, 20, 4)) AS customer_address,
       CASE WHEN CAST(account_number AS BIGINT) % 7 = 0 THEN NULL ELSE 'Torino' END AS customer_city,
       'TO' AS customer_state, '10100' AS zip, 'IT' AS country_cod, '19700131' AS date_birth, '' AS home_tel,
       '' AS work_tel, concat('TX', substring(account_number, 15, 9)) AS taxid_number, 'I' AS document_type,
       'Roma' AS city_birth, 'F' AS gender, 'IT' AS nationality,
       concat('c', substring(account_number, 18, 6), '@example.com') AS email, 'ENROL_1.txt' AS input_filename,
       '20240101000000' AS input_filename_timestamp, '20240102030405' AS elaboration_ts,
       '20240101000000' AS internallog_ts
FROM fx_master"""

# Accounts of the feed as enrolments; some that the master lacks belong to a new customer.
VIEWS["fx_enrolled"] = """
SELECT DISTINCT product_company,
       CASE WHEN CAST(account_number AS BIGINT) % 20 = 0 THEN concat('9', substring(customer_number, 2, 14)) ELSE customer_number END AS customer_number,
       account_number
FROM fx_feed
UNION ALL
SELECT DISTINCT product_company, concat('8', substring(customer_number, 2, 14)) AS customer_number, account_number
FROM fx_feed WHERE CAST(account_number AS BIGINT) % 40 = 0"""

# Enrolment lines, one attribute per line; 21 known attributes and two unknown ones.
VIEWS["fx_attribute"] = """
SELECT line_no, key_id,
       CASE WHEN line_no % 11 = 3 THEN 'LOYADD' WHEN line_no % 11 = 7 THEN 'LOYDEL' ELSE 'REQCARD' END AS function_id,
       CASE WHEN line_no % 13 = 5 THEN 'N' ELSE 'P' END AS result,
       CASE WHEN line_no % 17 = 2 THEN 'C' ELSE 'A' END AS key_type,
       alias_id,
       CASE alias_id WHEN 'X1142237' THEN CASE WHEN line_no % 4 = 1 THEN 'OTHER' ELSE key_id END
                     WHEN 'X11422QZ' THEN '18200'
                     WHEN 'X11422PC' THEN '18200'
                     WHEN 'X11422W0' THEN substring(key_id, 9, 15)
                     WHEN 'X1142239' THEN CASE WHEN line_no % 2 = 0 THEN concat('ANNA', CAST(line_no AS STRING), ' * ROSSI') ELSE concat('MARIO', CAST(line_no AS STRING)) END
                     WHEN 'X1142247' THEN CASE WHEN line_no % 3 = 0 THEN '0700131' WHEN line_no % 3 = 1 THEN '1010203' ELSE 'X990101' END
                     WHEN 'X11422UW' THEN CASE WHEN line_no % 2 = 0 THEN concat('u', CAST(line_no AS STRING), '§mail.it') ELSE concat('u', CAST(line_no AS STRING), 'Â§mail.it') END
                     ELSE concat('v', CAST(line_no AS STRING)) END AS value
FROM (SELECT line_no, key_id,
             CASE line_no % 23 WHEN 0 THEN 'X11422QZ' WHEN 1 THEN 'X1142237' WHEN 2 THEN 'X11422W0' WHEN 3 THEN 'X11422PC'
                  WHEN 4 THEN 'X1142239' WHEN 5 THEN 'X1142241' WHEN 6 THEN 'X1142244' WHEN 7 THEN 'X1142245'
                  WHEN 8 THEN 'X1142246' WHEN 9 THEN 'X1142250' WHEN 10 THEN 'X1142247' WHEN 11 THEN 'X1142248'
                  WHEN 12 THEN 'X1142249' WHEN 13 THEN 'X1142251' WHEN 14 THEN 'X1142252' WHEN 15 THEN 'X1142253'
                  WHEN 16 THEN 'X1142254' WHEN 17 THEN 'X11422BS' WHEN 18 THEN 'X11422UW' WHEN 19 THEN 'X11422FS'
                  WHEN 20 THEN 'X11422BI' WHEN 21 THEN 'X1142209' ELSE 'X9999999' END AS alias_id
      FROM fx_eav) a"""

# The attribute lines in the fixed-width layout, with one header per file (three files).
VIEWS["fx_enrolment_line"] = """
SELECT concat('ENROL_', CAST(line_no % 3 AS STRING), '.txt') AS input_filename, line_no,
       concat('20240101120000', rpad(concat('IBR', CAST(line_no % 100 AS STRING)), 11, ' '), rpad(function_id, 10, ' '),
              result, key_id, key_type, rpad(alias_id, 8, ' '), rpad(value, 132, ' ')) AS line
FROM fx_attribute
UNION ALL
SELECT concat('ENROL_', CAST(line_no % 3 AS STRING), '.txt') AS input_filename, CAST(-1 AS BIGINT) AS line_no,
       concat('ISSUER001', 'H', rpad('SENDER', 9, ' '), '2024010', CAST(line_no % 3 + 1 AS STRING), '120000',
              lpad(CAST(count(*) AS STRING), 9, '0'), rpad('', 34, ' '), 'SND01', 'CMP01', 'OWN01', 'OWN02', 'OWN03',
              '000000001', 'HEADER ') AS line
FROM fx_attribute GROUP BY line_no % 3
UNION ALL
SELECT 'ENROL_0.txt' AS input_filename, max(line_no) + 1 AS line_no,
       concat('20240101 H2024', rpad('LATE', 11, ' '), rpad('LATEHEADER', 10, ' '), 'P', rpad('LATE', 23, ' '), 'A',
              rpad('LATE', 8, ' '), rpad('no header', 132, ' ')) AS line
FROM fx_attribute
UNION ALL
SELECT 'ENROL_9.txt' AS input_filename, line_no,
       concat('20240101120000', rpad('IBR', 11, ' '), rpad('NOHEADER', 10, ' '), 'P', rpad(key_id, 23, ' '), 'A',
              rpad(alias_id, 8, ' '), rpad('no header', 132, ' ')) AS line
FROM fx_attribute WHERE line_no % 50 = 1"""

# The maintenance lines in the fixed-width layout; every 19th line names another company.
VIEWS["fx_maintenance_line"] = """
SELECT 'MAINT_20240105101112.txt' AS input_filename, '20240105101112' AS input_filename_timestamp, line_no,
       concat(CASE WHEN line_no % 19 = 0 THEN '18210' ELSE '18200' END, 'A', key_id, rpad('2024-01-05-10.11.12.000000', 26, ' '),
              rpad('USER', 8, ' '), rpad('2024-01-05-10.11.12.000001', 26, ' '), alias, maint_type,
              rpad(old_value, 500, ' '), rpad(new_value, 500, ' ')) AS line
FROM fx_eav"""

# A points file per remainder of the order key: header, account totals, transactions, one unknown type.
VIEWS["fx_points_line"] = """
SELECT concat('POINTS_', CAST(o_orderkey % 7 AS STRING), '.txt') AS input_filename, '20240110000000' AS input_filename_timestamp,
       o_orderkey AS line_no, line
FROM fx_fixed
UNION ALL
SELECT concat('POINTS_', CAST(k AS STRING), '.txt') AS input_filename, '20240110000000' AS input_filename_timestamp,
       CAST(-1 AS BIGINT) AS line_no,
       concat('06', '18200', rpad('', 15, ' '), 'PGM01', rpad('', 15, ' '), '0', CAST(k + 1 AS STRING), '012024') AS line
FROM (SELECT DISTINCT o_orderkey % 7 AS k FROM orders) f
UNION ALL
SELECT concat('POINTS_', CAST(CAST(account_number AS BIGINT) % 7 AS STRING), '.txt') AS input_filename,
       '20240110000000' AS input_filename_timestamp, CAST(account_number AS BIGINT) AS line_no,
       concat('18', '18200', rpad('', 15, ' '), 'PGM01', rpad('', 15, ' '), account_number, '1240101', '1251231',
              rpad('', 118, ' '), '1240131', '0991231', lpad('0', 15, '0'), lpad(CAST(abs(stated_total) AS STRING), 13, '0'), '0',
              CASE WHEN stated_total < 0 THEN 'è' ELSE 'à' END, lpad('0', 45, '0'), lpad('0', 15, '0'), lpad('0', 15, '0'),
              rpad('', 15, ' '), 'N') AS line
FROM fx_stated_total
UNION ALL
SELECT 'POINTS_0.txt' AS input_filename, '20240110000000' AS input_filename_timestamp, o_orderkey AS line_no,
       concat('99', CAST(o_orderkey AS STRING)) AS line
FROM orders WHERE o_orderkey % 50 = 0"""

# The points lines with a second total record for every tenth account; the last one of an account counts.
VIEWS["fx_points_record"] = """
SELECT input_filename, line_no, line FROM fx_points_line
UNION ALL
SELECT 'POINTS_0.txt' AS input_filename, CAST(account_number AS BIGINT) + 1000000000 AS line_no,
       concat('18', '18200', rpad('', 15, ' '), 'PGM01', rpad('', 15, ' '), account_number, '1240101', '1251231',
              rpad('', 118, ' '), '1240131', '0991231', lpad('0', 15, '0'), lpad('7', 13, '0'), '0', 'à',
              lpad('0', 45, '0'), lpad('0', 15, '0'), lpad('0', 15, '0'), rpad('', 15, ' '), 'N') AS line
FROM fx_stated_total WHERE CAST(account_number AS BIGINT) % 10 = 0"""

# Order dates in both encodings, with a few that are none.
VIEWS["fx_date"] = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 31 = 0 THEN 'X990101' WHEN o_orderkey % 37 = 0 THEN '' WHEN o_orderkey % 41 = 0 THEN '1990230'
            ELSE concat(CASE WHEN substring(day, 1, 2) = '19' THEN '0' ELSE '1' END, substring(day, 3, 6)) END AS century_raw,
       concat(substring(day, 7, 2), substring(day, 5, 2), substring(day, 1, 4)) AS day_first_raw
FROM (SELECT o_orderkey, replace(substring(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 10), '-', '') AS day FROM orders) d"""

# Currency numbers: those of the fixed-width lines, and all numbers from 000 to 999.
VIEWS["fx_currency"] = """
SELECT o_orderkey, substring(line, 113, 3) AS currency_number FROM fx_fixed
UNION ALL
SELECT o_orderkey, lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0') AS currency_number FROM orders"""

VIEWS["fx_contact"] = """
SELECT c_custkey,
       CASE WHEN c_custkey % 4 = 0 THEN concat(c_name, ' * ', c_mktsegment, ' ') WHEN c_custkey % 4 = 1 THEN c_name
            WHEN c_custkey % 4 = 2 THEN concat(c_name, '*', c_mktsegment, '*X') ELSE concat('*', c_name) END AS full_name,
       CASE WHEN c_custkey % 3 = 0 THEN concat(c_name, '§mail.it') WHEN c_custkey % 3 = 1 THEN concat(c_name, 'Â§mail.it')
            ELSE concat(c_name, '@mail.it') END AS email_raw
FROM customer"""


def _needs(sql: str) -> list[str]:
    return [name for name in VIEWS if re.search(rf"\b{name}\b", sql)]


def _closure(names: list[str]) -> list[str]:
    """Views in the order in which they must be defined."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in _needs(VIEWS[name]):
                visit(other)
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def with_views(body: str) -> str:
    """An oracle statement: ``body`` after the stand-ins it mentions."""
    names = _closure(_needs(body))
    if not names:
        return body.strip()
    definitions = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in names)
    head, rest = "WITH ", body.strip()
    if rest[:5].upper() == "WITH ":
        rest = ", " + rest[5:]
    return f"{head}{definitions}{chr(10) if not rest.startswith(',') else ''}{rest}"


_SCHEMAS: dict[str, StructType] = {}


def _given(spark: SparkSession, path: str) -> DataFrame:
    """A given table; its schema is taken from the file once, later reads need no job for it."""
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stand-in over the whole given tables."""
    needed = _closure([name])
    for table in BASE_TABLES:
        if any(re.search(rf"\b{table}\b", VIEWS[each]) for each in needed):
            _given(spark, f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    for each in needed:
        spark.sql(VIEWS[each]).createOrReplaceTempView(each)
    return spark.table(name)

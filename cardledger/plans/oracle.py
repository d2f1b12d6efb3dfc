"""DuckDB statements that give the results of the catalogue by other means."""

from __future__ import annotations

from cardledger.functions.currency import CURRENCIES
from cardledger.plans.catalogue import RUN_TS
from cardledger.plans.stand_ins import with_views
from cardledger.schemas import ACTION_FILE, ENROLMENT_ALIASES, MAINTENANCE_DETAIL

SQL: dict[str, str] = {}

_FEED_AMOUNT = "CAST(concat(f.sign, f.value) AS DECIMAL(18,3))"
_LEDGER_ID = "f.appcode || f.transaction_id || '_' || f.transaction_date || '_' || f.input_filename_timestamp"


def _pieces(layout: dict[str, tuple[int, int]], line: str = "line") -> str:
    return ", ".join(f"trim(substring({line}, {a + 1}, {b - a})) AS {name}" for name, (a, b) in layout.items())


# ---- sources ---------------------------------------------------------------

SQL["pending_files"] = """
SELECT input_filename, substring(input_filename, 6, 1) AS input_filename_timestamp,
       substring(input_filename, 8, 17) AS listed_timestamp
FROM fx_feed ORDER BY input_filename LIMIT 1"""

SQL["waiting_batch"] = """
WITH fresh AS (SELECT * FROM fx_movement WHERE input_filename IN ('FEED_1.csv', 'FEED_2.csv', 'FEED_4.csv'))
SELECT 'e_partner' AS table_name, transaction_id, value, input_filename, substring(input_filename, 6, 1) AS input_filename_timestamp,
       CAST(NULL AS VARCHAR) AS line
FROM fresh WHERE causal NOT LIKE '%;%'
UNION ALL
SELECT 'rejected_lines', NULL, NULL, input_filename, NULL,
       concat_ws(';', appcode, product_company, customer_number, transaction_id, transaction_date, transaction_type, sign,
                 currency, value, causal, causalcode, internallog_ts)
FROM fresh WHERE causal LIKE '%;%'
UNION ALL
SELECT DISTINCT 'loaded_files', NULL, NULL, input_filename, NULL, NULL FROM fx_movement WHERE input_filename < 'FEED_5.csv'"""

SQL["delimited_scan"] = f"""
SELECT appcode, product_company, customer_number, transaction_id, transaction_date, transaction_type, sign, currency,
       value, causal, causalcode, 'part-' AS input_filename, CAST(5 AS INTEGER) AS input_filename_timestamp,
       '{RUN_TS}' AS elaboration_ts, internallog_ts, CAST(NULL AS VARCHAR) AS line, CAST(NULL AS VARCHAR) AS reason
FROM fx_movement WHERE causal NOT LIKE '%;%'
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       concat_ws(';', appcode, product_company, customer_number, transaction_id, transaction_date, transaction_type, sign,
                 currency, value, causal, causalcode, internallog_ts), 'field count'
FROM fx_movement WHERE causal LIKE '%;%'"""

SQL["fixed_width_scan"] = "SELECT line FROM fx_fixed"

SQL["staged_file_name"] = "SELECT min(input_filename) AS input_filename FROM fx_feed"

SQL["stage_if_new"] = """
SELECT transaction_id, input_filename, internallog_ts, value FROM fx_movement f
WHERE NOT EXISTS (SELECT 1 FROM fx_loaded_log l WHERE l.input_filename = f.input_filename)
  AND NOT EXISTS (SELECT 1 FROM fx_loaded_log l WHERE l.internallog_ts = f.internallog_ts)"""

# ---- decoding --------------------------------------------------------------

_PLUS, _MINUS = "àABCDEFGHI", "èJKLMNOPQR"


def _sign(raw: str) -> str:
    return (
        f"CASE WHEN strpos('{_PLUS}', right({raw}, 1)) > 0 THEN '+' "
        f"WHEN strpos('{_MINUS}', right({raw}, 1)) > 0 THEN '-' END"
    )


def _digits(raw: str) -> str:
    # A digit for each sign character; a bad one leaves a character that is no digit.
    return (
        f"nullif(regexp_extract(left({raw}, length({raw}) - 1) || "
        f"translate(right({raw}, 1), '{_PLUS}{_MINUS}', '01234567890123456789'), '^[0-9]+$'), '')"
    )


def _points_text(raw: str) -> str:
    return f"CASE WHEN {_digits(raw)} IS NOT NULL THEN coalesce(nullif(ltrim(left({raw}, length({raw}) - 2), '0'), ''), '0') END"


def _amount(raw: str) -> str:
    return f"CAST(CAST({_digits(raw)} AS DECIMAL(15,0)) / 100 AS DECIMAL(15,2))"


def _century(raw: str) -> str:
    return (
        f"(CASE substring({raw}, 1, 1) WHEN '0' THEN '19' WHEN '1' THEN '20' WHEN '2' THEN '21' ELSE 'ER' END "
        f"|| substring({raw}, 2, 6))"
    )


SQL["decode_points"] = f"""
SELECT 'CAMS' AS appcode, substring(line, 3, 5) AS product_company, substring(line, 43, 23) AS account_number,
       'PGM01' AS loyalty_program_cod, substring(line, 66, 23) || substring(line, 111, 2) AS transaction_id,
       {_century("substring(line, 89, 7)")} AS transaction_date, {_amount("substring(line, 96, 15)")} AS transaction_value,
       'VC' AS transaction_type, {_sign("substring(line, 131, 15)")} AS sign, 'EUR' AS currency,
       {_points_text("substring(line, 131, 15)")} AS value, 'Buoni sconto per utilizzo carta' AS causal,
       'GT' AS causalcode, 'POINTS_' || CAST(o_orderkey % 7 AS VARCHAR) || '.txt' AS input_filename,
       '20240110000000' AS input_filename_timestamp, '{RUN_TS}' AS elaboration_ts,
       '2024010' || CAST(o_orderkey % 7 + 1 AS VARCHAR) || '0000000' AS internallog_ts
FROM fx_fixed"""

SQL["decode_point_totals"] = """
SELECT 'POINTS_' || CAST(CAST(account_number AS BIGINT) % 7 AS VARCHAR) || '.txt' AS input_filename,
       '18200' AS product_company, 'PGM01' AS programme, account_number, '1240101' AS effective_date,
       '1251231' AS expiry_date, '20240131' AS cycle_end_date, '19991231' AS award_cycle_date, 'N' AS expiry_flag,
       stated_total AS points
FROM fx_stated_total"""

SQL["decode_enrolment"] = """
SELECT '20240101120000' AS issuer_batch_id, concat('IBR', CAST(line_no % 100 AS VARCHAR)) AS ibr_key, function_id, result,
       key_id AS key_of_function, key_type, alias_id, value,
       concat('ENROL_', CAST(line_no % 3 AS VARCHAR), '.txt') AS input_filename, line_no,
       '2024010' || CAST(line_no % 3 + 1 AS VARCHAR) || '120000' AS header_batch_id
FROM fx_attribute
UNION ALL
SELECT '20240101 H2024', 'LATE', 'LATEHEADER', 'P', 'LATE', 'A', 'LATE', 'no header', 'ENROL_0.txt', max(line_no) + 1,
       '20240101120000'
FROM fx_attribute
UNION ALL
SELECT '20240101120000', 'IBR', 'NOHEADER', 'P', key_id, 'A', alias_id, 'no header', 'ENROL_9.txt', line_no, NULL
FROM fx_attribute WHERE line_no % 50 = 1"""

SQL["enrolment_counts"] = """
SELECT concat('ENROL_', CAST(line_no % 3 AS VARCHAR), '.txt') AS input_filename, count(*) AS lines_stated,
       count(*) + CASE WHEN line_no % 3 = 0 THEN 1 ELSE 0 END AS lines_read, line_no % 3 <> 0 AS counts_agree
FROM fx_attribute GROUP BY line_no % 3
UNION ALL
SELECT 'ENROL_9.txt', NULL, count(*), false FROM fx_attribute WHERE line_no % 50 = 1"""

SQL["decode_maintenance"] = f"""
SELECT {_pieces(MAINTENANCE_DETAIL)}, input_filename, input_filename_timestamp, line_no,
       input_filename_timestamp AS internallog_ts
FROM fx_maintenance_line"""

# ---- scalar functions ------------------------------------------------------

SQL["overpunch_decode"] = f"""
SELECT o_orderkey, {_sign("raw")} AS sign, {_digits("raw")} AS digits, {_points_text("raw")} AS points_text,
       CAST({_sign("raw")} || {_points_text("raw")} AS BIGINT) AS points, {_amount("raw")} AS amount
FROM fx_overpunch"""

SQL["century_date"] = f"""
SELECT o_orderkey, {_century("century_raw")} AS century_text,
       CAST(try_strptime({_century("century_raw")}, '%Y%m%d') AS DATE) AS century_day,
       substring(day_first_raw, 5, 4) || substring(day_first_raw, 3, 2) || substring(day_first_raw, 1, 2) AS day_first_text
FROM fx_date"""

SQL["currency_lookup"] = """
SELECT c.o_orderkey, c.currency_number, coalesce(t.code, 'EUR') AS currency_code
FROM fx_currency c LEFT JOIN (VALUES {}) t(number, code) ON c.currency_number = t.number""".format(
    ", ".join(f"('{n}', '{c}')" for n, c in CURRENCIES.items())
)

SQL["name_split"] = """
SELECT c_custkey,
       CASE WHEN strpos(full_name, '*') > 0 THEN trim(split_part(full_name, '*', 1)) ELSE full_name END AS customer_name,
       CASE WHEN strpos(full_name, '*') > 0 THEN trim(split_part(full_name, '*', 2)) ELSE '' END AS customer_surname
FROM fx_contact"""

SQL["email_repair"] = """
SELECT c_custkey, replace(replace(email_raw, 'Â§', '@'), '§', '@') AS email FROM fx_contact"""

SQL["transaction_key"] = f"""
SELECT transaction_id, {_LEDGER_ID} AS ledger_id, f.appcode || f.transaction_id || '_' || f.transaction_date AS movement_id
FROM fx_feed f"""

SQL["partner_units"] = """
SELECT transaction_id, transaction_type,
       CASE WHEN transaction_type = 'VC' THEN CAST(value AS BIGINT) // 10 ELSE CAST(value AS BIGINT) * 100 END AS transaction_value,
       CASE WHEN transaction_type = 'VC' THEN CAST(value AS BIGINT) // 1000 ELSE CAST(value AS BIGINT) * 100 END AS value
FROM fx_movement"""

# ---- pivots ----------------------------------------------------------------

_KEPT = "function_id = 'REQCARD' AND result = 'P' AND alias_id IN ({})".format(
    ", ".join(f"'{alias}'" for alias in ENROLMENT_ALIASES)
)


def _last(alias: str) -> str:
    return f"coalesce(arg_max(value, line_no) FILTER (WHERE alias_id = '{alias}'), '')"


_PLAIN = [name for name in ENROLMENT_ALIASES.values() if name not in ("full_name", "date_birth", "email")]

SQL["pivot_enrolment"] = """
WITH wide AS (SELECT key_id AS key_of_function, {columns}, '20240101120000' AS issuer_batch_id
              FROM fx_attribute WHERE {kept} GROUP BY key_id)
SELECT key_of_function, {plain}, issuer_batch_id, {birth} AS date_birth,
       replace(replace(email, 'Â§', '@'), '§', '@') AS email,
       CASE WHEN strpos(full_name, '*') > 0 THEN trim(split_part(full_name, '*', 1)) ELSE full_name END AS customer_name,
       CASE WHEN strpos(full_name, '*') > 0 THEN trim(split_part(full_name, '*', 2)) ELSE '' END AS customer_surname
FROM wide""".format(
    columns=", ".join(f"{_last(alias)} AS {name}" for alias, name in ENROLMENT_ALIASES.items()),
    kept=_KEPT,
    plain=", ".join(_PLAIN),
    birth=_century("date_birth"),
)

SQL["programme_events"] = f"""
SELECT function_id, key_id AS key_of_function, {_last("X1142237")} AS account_number,
       {_last("X11422FS")} AS loyalty_program_cod, {_last("X11422BI")} AS loyalty_program_status
FROM fx_attribute
WHERE result = 'P' AND key_type = 'A'
  AND ((function_id IN ('LOYADD', 'LOYDEL') AND alias_id = 'X1142237' AND key_id = value)
       OR (function_id = 'LOYADD' AND alias_id IN ('X11422FS', 'X11422BI')))
GROUP BY function_id, key_id"""

SQL["programme_errors"] = """
SELECT line_no, function_id, key_id AS key_of_function, value FROM fx_attribute
WHERE result = 'P' AND key_type = 'A' AND function_id IN ('LOYADD', 'LOYDEL') AND alias_id = 'X1142237' AND key_id <> value"""

_PAIRS = {
    "plastic_status": ("alias = 'X11422C2'", 2),
    "cup": ("alias = 'X11422PG' AND maint_type = 'C'", 15),
    "livrea": ("alias = 'X1142289' AND maint_type = 'A'", 3),
    "dealer": ("alias = 'X1142278' AND maint_type = 'A'", 25),
    "convenzione": ("alias = 'X1142234' AND maint_type = 'A'", 25),
}

_PIVOTED = "SELECT key_id, {} FROM fx_eav GROUP BY key_id HAVING {}".format(
    ", ".join(
        f"coalesce(arg_max(left({side}_value, {width}), line_no) FILTER (WHERE {rule}), '') AS {name}_{side}"
        for name, (rule, width) in _PAIRS.items()
        for side in ("old", "new")
    ),
    "count(*) FILTER (WHERE {}) > 0".format(" OR ".join(f"({rule})" for rule, _ in _PAIRS.values())),
)

SQL["pivot_maintenance"] = _PIVOTED

# ---- routing ---------------------------------------------------------------


def _reason(key: str, active: str) -> str:
    return (
        f"CASE WHEN {key} IS NULL THEN 'unknown account' WHEN {active} IS NULL THEN 'unknown state' "
        f"WHEN NOT {active} THEN 'inactive' END"
    )


_ROUTE = "CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS route"
_BY_ACCOUNT = "fx_master m ON f.product_company = m.product_company AND f.account_number = m.account_number"

SQL["route_points"] = f"""
SELECT *, {_ROUTE} FROM (
  SELECT f.transaction_id, f.product_company, f.account_number, m.customer_number AS master_customer_number,
         {_reason("m.account_number", "m.is_customer_number_active")} AS reason
  FROM fx_feed f LEFT JOIN {_BY_ACCOUNT}) r"""

_STATUS_PAIRS = ", ".join(f"p.{name}_{side}" for name in _PAIRS for side in ("old", "new"))

SQL["route_maintenance"] = f"""
WITH pivoted AS ({_PIVOTED})
SELECT 'CAMS' AS appcode, '18200' AS product_company, m.customer_number, p.key_id AS account_number,
       'MAINT_20240105101112.txt' AS input_filename, '20240105101112' AS input_filename_timestamp,
       '{RUN_TS}' AS elaboration_ts, {_STATUS_PAIRS},
       m.customer_name AS customer_name_an, m.customer_surname AS customer_surname_an, m.taxid_number,
       CASE WHEN m.account_number IS NULL THEN 'rejected' ELSE 'accepted' END AS route,
       CASE WHEN m.account_number IS NULL THEN 'unknown account' END AS reason
FROM pivoted p LEFT JOIN fx_anag m ON m.product_company = '18200' AND m.account_number = p.key_id"""

_IN_MASTER = (
    "EXISTS (SELECT 1 FROM fx_master m WHERE m.product_company = f.product_company "
    "AND m.account_number = f.account_number)"
)

_ENROLMENT_REASON = (
    f"CASE WHEN {_IN_MASTER} THEN 'already in master' WHEN (SELECT count(*) FROM fx_enrolled g WHERE "
    "g.product_company = f.product_company AND g.account_number = f.account_number) > 1 THEN 'repeated account' END"
)

SQL["route_enrolment"] = f"""
SELECT product_company, customer_number, account_number,
       CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS route, reason
FROM (SELECT f.*, {_ENROLMENT_REASON} AS reason FROM fx_enrolled f) k"""

_SAVEBACK = f"""
  SELECT f.transaction_id, f.product_company, f.customer_number,
         EXISTS (SELECT 1 FROM fx_ledger l WHERE l.product_company = f.product_company AND l.customer_number = f.customer_number
                 AND regexp_replace(l.transaction_id, '_[0-9]+$', '') = f.appcode || f.transaction_id || '_' || f.transaction_date) AS sent_before,
         coalesce({_reason("c.customer_number", "c.active")},
                  CASE WHEN EXISTS (SELECT 1 FROM fx_ledger l WHERE l.product_company = f.product_company
                                    AND l.customer_number = f.customer_number AND l.transaction_id = {_LEDGER_ID})
                       THEN 'already in ledger' END) AS reason
  FROM fx_feed f LEFT JOIN (SELECT product_company, customer_number, bool_or(is_customer_number_active) AS active
                            FROM fx_master GROUP BY product_company, customer_number) c
       ON f.product_company = c.product_company AND f.customer_number = c.customer_number"""

SQL["route_saveback"] = f"SELECT *, {_ROUTE} FROM ({_SAVEBACK}) r"

_CODES = f"""
  SELECT f.*, m.account_number AS found, m.is_customer_number_active AS active,
         TRY_CAST(f.value AS DECIMAL(18,3)) AS amount
  FROM fx_partner f LEFT JOIN {_BY_ACCOUNT}"""

_CODE_RULES = [
    ("00", "Elaborato Con Successo", "found IS NOT NULL AND active AND amount IS NOT NULL"),
    ("01", "CustomerNumber Inesistente", "found IS NULL"),
    ("02", "CustomerNumber Non Attivo", "found IS NOT NULL AND active IS NOT TRUE"),
    ("07", "Value Non Valido", "found IS NOT NULL AND active AND amount IS NULL"),
    ("03", "ApplicationCode Non Valido", "appcode <> 'CHP'"),
    ("04", "ClientNumber Non Valido", "product_company <> '18200'"),
    ("05", "Type Non Valido", "transaction_type NOT IN ('VC', 'E')"),
    ("06", "CausalCode Non Valido", "causalcode NOT IN ('BB', 'DA', 'PC', 'PB', 'CC', 'WB')"),
]

SQL["partner_response"] = f"WITH matched AS ({_CODES})\n" + "\nUNION ALL\n".join(
    f"SELECT appcode, product_company, account_number AS customer_number, transaction_id, transaction_date, "
    f"transaction_type, sign, currency, value, causal, causalcode, input_filename_timestamp, "
    f"'{code}' AS response_code, '{text}' AS response_text FROM matched WHERE {rule}"
    for code, text, rule in _CODE_RULES
)

SQL["response_file_name"] = """
SELECT DISTINCT substring(input_filename, 1, 30) || '_SIAResponse.csv' AS response_filename FROM fx_feed"""

SQL["reject_union"] = f"""
WITH by_account AS (SELECT f.transaction_id, {_reason("m.account_number", "m.is_customer_number_active")} AS reason
                    FROM fx_feed f LEFT JOIN {_BY_ACCOUNT}),
     by_partner AS (SELECT transaction_id, CASE WHEN reason IS NULL AND amount IS NULL THEN 'bad amount' ELSE reason END AS reason
                    FROM (SELECT f.transaction_id, TRY_CAST(f.value AS DECIMAL(18,3)) AS amount,
                                 {_reason("m.account_number", "m.is_customer_number_active")} AS reason
                          FROM fx_partner f LEFT JOIN {_BY_ACCOUNT}) p),
     by_customer AS ({_SAVEBACK})
SELECT 'points' AS feed, transaction_id, reason FROM by_account WHERE reason IS NOT NULL
UNION ALL SELECT 'partner', transaction_id, reason FROM by_partner WHERE reason IS NOT NULL
UNION ALL SELECT 'saveback', transaction_id, reason FROM by_customer WHERE reason IS NOT NULL"""

SQL["distinct_rows"] = "SELECT DISTINCT account_number, plastic_status_old, plastic_status_new FROM fx_transition"

# ---- balances and ledgers --------------------------------------------------

SQL["signed_points"] = f"""
SELECT product_company, customer_number, transaction_type, CAST(sum({_FEED_AMOUNT}) AS DECIMAL(28,3)) AS points
FROM fx_feed f GROUP BY product_company, customer_number, transaction_type"""

SQL["balance_delta"] = f"""
SELECT product_company, customer_number,
       CAST(coalesce(sum({_FEED_AMOUNT}) FILTER (WHERE transaction_type = 'VC'), 0) * 0.001 AS DECIMAL(28,6)) AS delta_virtualcredit,
       CAST(coalesce(sum({_FEED_AMOUNT}) FILTER (WHERE transaction_type = 'E'), 0) AS DECIMAL(28,6)) AS delta_extrabonus,
       count(*) AS movements
FROM fx_feed f GROUP BY product_company, customer_number"""

SQL["balance_update"] = f"""
WITH moved AS (
  SELECT m.product_company, m.customer_number, sum({_FEED_AMOUNT}) FILTER (WHERE f.transaction_type = 'VC') AS vc,
         sum({_FEED_AMOUNT}) FILTER (WHERE f.transaction_type = 'E') AS eb
  FROM fx_feed f JOIN {_BY_ACCOUNT} WHERE m.is_customer_number_active GROUP BY m.product_company, m.customer_number)
SELECT b.product_company, b.customer_number,
       CAST(b.balance_virtualcredit + coalesce(v.vc, 0) AS DECIMAL(18,3)) AS balance_virtualcredit,
       CAST(b.balance_extrabonus + coalesce(v.eb, 0) AS DECIMAL(18,3)) AS balance_extrabonus
FROM fx_balance b LEFT JOIN moved v ON b.product_company = v.product_company AND b.customer_number = v.customer_number"""

_O, _N = "plastic_status_old", "plastic_status_new"
_RULE = (
    f"CASE WHEN {_N} = 'KK' THEN 1 WHEN {_N} IN ('CB', 'CT', 'GD') THEN 2 "
    f"WHEN {_N} IN ('KD', 'JD') OR ({_O} = 'AA' AND {_N} = 'DD') THEN 3 "
    f"WHEN {_O} = '' AND {_N} = 'AA' THEN 4 WHEN {_O} IN ('KK', 'DD') AND {_N} = 'AA' THEN 5 END"
)
_PLASTIC = f"CASE WHEN {_N} = 'KK' THEN 'KK' WHEN {_N} = 'AA' OR {_O} = 'AA' THEN 'OL' WHEN {_O} = 'KK' THEN 'KK' END"
_ACTIONS = (
    "CASE WHEN action_rule IN (1, 4) THEN 'I' WHEN action_rule = 2 THEN 'D' ELSE 'U' END AS action_anagrafica, "
    "CASE WHEN action_rule = 2 THEN 'Z' ELSE '' END AS action_bonus, "
    "CASE WHEN action_rule = 2 THEN 'Z' WHEN action_rule IN (1, 3) THEN 'B' ELSE '' END AS action_extrabonus"
)

SQL["card_actions"] = f"""
SELECT account_number, line_no, action_rule, {_ACTIONS}, plastic_type
FROM (SELECT *, CAST({_RULE} AS INTEGER) AS action_rule, {_PLASTIC} AS plastic_type FROM fx_transition) a
WHERE action_rule IS NOT NULL AND plastic_type IS NOT NULL"""

_EMPTY = (
    "customer_address customer_city customer_state zip country_cod date_birth home_tel work_tel city_birth "
    "gender nationality email"
).split()

SQL["maintenance_actions"] = f"""
WITH pivoted AS ({_PIVOTED}),
     ruled AS (SELECT p.*, CAST({_RULE} AS INTEGER) AS action_rule, {_PLASTIC} AS plastic_type FROM pivoted p)
SELECT 'CAMS' AS appcode, '18200' AS product_company, m.customer_number, cup_new AS cup, livrea_new AS livrea,
       convenzione_new AS convenzione, dealer_new AS dealer, plastic_type, m.customer_name, m.customer_surname,
       m.taxid_number, {", ".join(f"'' AS {name}" for name in _EMPTY)}, substring('{RUN_TS}', 1, 8) AS data,
       'CAMS{RUN_TS}18200' || m.customer_number AS actionid, {_ACTIONS}, '{RUN_TS}' AS elaboration_ts
FROM ruled r JOIN fx_anag m ON m.product_company = '18200' AND m.account_number = r.key_id
WHERE action_rule IS NOT NULL AND plastic_type IS NOT NULL"""

# The latest closing line of every customer.
_CLOSED = f"""
  SELECT product_company, customer_number, {_N}, line_no FROM (
    SELECT m.product_company, m.customer_number, t.{_N}, t.line_no,
           row_number() OVER (PARTITION BY m.product_company, m.customer_number ORDER BY t.line_no DESC, t.{_N}) AS n
    FROM fx_transition t JOIN fx_master m ON m.product_company = '18200' AND m.account_number = t.account_number
    WHERE t.{_N} IN ('CB', 'CT', 'GD')) c WHERE n = 1"""

SQL["balance_close"] = f"""
WITH closed AS ({_CLOSED})
SELECT b.product_company, b.customer_number,
       CAST(CASE WHEN c.line_no IS NOT NULL THEN 0 ELSE coalesce(b.balance_virtualcredit, 0) END AS DECIMAL(18,3)) AS balance_virtualcredit,
       CAST(CASE WHEN c.line_no IS NOT NULL THEN 0 ELSE coalesce(b.balance_extrabonus, 0) END AS DECIMAL(18,3)) AS balance_extrabonus
FROM fx_balance b LEFT JOIN closed c ON b.product_company = c.product_company AND b.customer_number = c.customer_number"""

SQL["balance_zero_all"] = """
SELECT product_company, customer_number, balance_virtualcredit, CAST(0 AS DECIMAL(18,3)) AS balance_extrabonus FROM fx_balance"""

SQL["account_disable"] = f"""
WITH closed AS ({_CLOSED})
SELECT a.product_company, a.customer_number, a.account_number,
       CASE WHEN c.line_no IS NOT NULL THEN false ELSE a.is_customer_number_active END AS is_customer_number_active,
       CASE WHEN c.line_no IS NOT NULL THEN false ELSE a.is_account_number_active END AS is_account_number_active,
       coalesce(c.{_N}, a.customer_status) AS customer_status, coalesce(c.{_N}, a.account_status) AS account_status,
       coalesce(CAST(c.line_no AS VARCHAR), a.elaboration_ts) AS elaboration_ts
FROM fx_anag a LEFT JOIN closed c ON a.product_company = c.product_company AND a.customer_number = c.customer_number"""

_ENROL_VALUES = {
    "cup": "''",
    "livrea": "''",
    "convenzione": "''",
    "dealer": "''",
    "plastic_type": "''",
    "data": "left(elaboration_ts, 8)",
    "actionid": "appcode || elaboration_ts || product_company || customer_number",
    "action_anagrafica": "'I'",
    "action_bonus": "''",
    "action_extrabonus": "''",
}

SQL["enrolment_actions"] = "SELECT {} FROM fx_anag".format(
    ", ".join(f"{_ENROL_VALUES[name]} AS {name}" if name in _ENROL_VALUES else name for name in ACTION_FILE)
)

SQL["open_balances"] = f"""
SELECT DISTINCT product_company AS customer_company, product_company, customer_number,
       CAST(0 AS DECIMAL(18,3)) AS balance_extrabonus, CAST(0 AS DECIMAL(18,3)) AS balance_virtualcredit,
       '{RUN_TS}' AS elaboration_ts
FROM fx_enrolled f
WHERE {_ENROLMENT_REASON} IS NULL AND NOT EXISTS (SELECT 1 FROM fx_balance b
      WHERE b.product_company = f.product_company AND b.customer_number = f.customer_number)"""

_LEDGER_COLUMNS = f"""f.loyalty_program_cod, {_LEDGER_ID} AS transaction_id, f.transaction_date,
       CAST(f.transaction_value AS DECIMAL(18,2)) AS transaction_value, f.transaction_type, f.sign, f.currency,
       CAST(f.value AS DECIMAL(18,3)) AS value, f.causal, f.causalcode, f.input_filename, f.input_filename_timestamp,
       f.elaboration_ts, f.internallog_ts"""

_HISTORY = "CAST(f.transaction_id AS BIGINT) % 3 = 0"

SQL["ledger_append"] = f"""
SELECT f.appcode, f.product_company, f.customer_number, {_LEDGER_COLUMNS} FROM fx_movement f WHERE {_HISTORY}
UNION ALL
SELECT f.appcode, f.product_company, m.customer_number, {_LEDGER_COLUMNS}
FROM fx_movement f JOIN {_BY_ACCOUNT} WHERE m.is_customer_number_active"""

# ---- output lines and control ---------------------------------------------

SQL["partner_lines"] = f"""
SELECT concat_ws(';', f.appcode, f.product_company, f.customer_number, {_LEDGER_ID}, f.transaction_date,
                 CAST(f.transaction_value AS VARCHAR), f.transaction_type, f.sign, f.currency, f.value,
                 replace(f.causal, ';', ' '), f.causalcode, f.elaboration_ts) AS line
FROM fx_movement f"""

SQL["points_reconcile"] = f"""
SELECT 'PGM01' AS programme, coalesce(s.account_number, t.account_number) AS account_number, t.stated_total, s.summed_total,
       CAST(coalesce(t.stated_total, 0) - coalesce(s.summed_total, 0) AS BIGINT) AS difference
FROM (SELECT substring(line, 43, 23) AS account_number,
             CAST(sum(CAST({_sign("substring(line, 131, 15)")} || {_points_text("substring(line, 131, 15)")} AS BIGINT)) AS BIGINT) AS summed_total
      FROM fx_fixed GROUP BY 1) s
FULL JOIN (SELECT account_number, CASE WHEN CAST(account_number AS BIGINT) % 10 = 0 THEN 7 ELSE stated_total END AS stated_total
           FROM fx_stated_total) t ON s.account_number = t.account_number"""

SQL["feed_control"] = f"""
WITH routed AS (SELECT f.product_company, f.causal, m.customer_number,
                       {_reason("m.account_number", "m.is_customer_number_active")} AS reason
                FROM fx_movement f LEFT JOIN {_BY_ACCOUNT})
SELECT 'rows_read' AS measure, count(*) AS n FROM routed
UNION ALL SELECT 'rows_accepted', count(*) FROM routed WHERE reason IS NULL
UNION ALL SELECT 'rows_rejected', count(*) FROM routed WHERE reason IS NOT NULL
UNION ALL SELECT 'rows_of_other_company', count(*) FROM routed WHERE product_company <> '18200'
UNION ALL SELECT 'movements_without_balance', count(*) FROM routed r WHERE reason IS NULL AND NOT EXISTS (
  SELECT 1 FROM fx_balance b WHERE b.product_company = r.product_company AND b.customer_number = r.customer_number)
UNION ALL SELECT 'ledger_before', count(*) FROM fx_history
UNION ALL SELECT 'ledger_after', (SELECT count(*) FROM fx_history) + (SELECT count(*) FROM routed WHERE reason IS NULL)
UNION ALL SELECT 'maintenance_lines_of_other_company', count(*) FROM fx_eav WHERE line_no % 19 = 0
UNION ALL SELECT 'delimiters_replaced', count(*) FROM routed WHERE reason IS NULL AND causal LIKE '%;%'"""

# ---- whole feeds -------------------------------------------------------------


def _fed(staged: str, credit: str, bonus: str, routes: str, ledger: str, more: str = "") -> str:
    """What a run leaves, from its staged rows with customer (``found``), ``amount`` and ``reason``.

    ``credit`` and ``bonus`` are what a row adds to a balance; ``routes`` and ``ledger`` list the seven
    columns that the route tables and the ledger show; ``more`` adds rows of other tables.
    """
    nothing = ", ".join(["NULL"] * 3)
    return f"""
WITH staged AS ({staged}),
moved AS (SELECT product_company, found, sum({credit}) AS credit, sum({bonus}) AS bonus
          FROM staged WHERE reason IS NULL GROUP BY product_company, found)
SELECT 'l_balance' AS table_name, b.product_company, b.customer_number, CAST(NULL AS VARCHAR) AS transaction_id,
       CAST(NULL AS VARCHAR) AS transaction_date, CAST(NULL AS VARCHAR) AS loyalty_program_cod,
       CAST(NULL AS VARCHAR) AS transaction_value, CAST(NULL AS VARCHAR) AS value,
       CAST(CAST(b.balance_extrabonus + coalesce(m.bonus, 0) AS DECIMAL(18,3)) AS VARCHAR) AS balance_extrabonus,
       CAST(CAST(b.balance_virtualcredit + coalesce(m.credit, 0) AS DECIMAL(18,3)) AS VARCHAR) AS balance_virtualcredit,
       CAST(NULL AS VARCHAR) AS line, CAST(NULL AS VARCHAR) AS reason
FROM fx_balance b LEFT JOIN moved m ON b.product_company = m.product_company AND b.customer_number = m.found
UNION ALL SELECT 'i_feed', {routes}, {nothing}, NULL FROM staged WHERE reason IS NULL
UNION ALL SELECT 'i_feed_rejected', {routes}, {nothing}, reason FROM staged WHERE reason IS NOT NULL
UNION ALL SELECT 'l_transaction', {ledger}, {nothing}, NULL FROM staged WHERE reason IS NULL
{more}"""


def _feed_reason(active: str, found: str, booked: str = "false") -> str:
    return (
        f"CASE WHEN {found} IS NULL THEN 'unknown account' WHEN {active} IS NULL THEN 'unknown state' "
        f"WHEN NOT {active} THEN 'inactive' WHEN TRY_CAST(concat(sign, value) AS DECIMAL(18,3)) IS NULL THEN 'bad amount' "
        f"WHEN {booked} THEN 'already in ledger' END AS reason"
    )


def _feed_id(appcode: str = "appcode") -> str:
    return f"{appcode} || transaction_id || '_' || transaction_date || '_part'"


_MONEY = "CAST(CAST({} AS DECIMAL(18,{})) AS VARCHAR)"

SQL["feed_points"] = _fed(
    f"""SELECT p.*, m.customer_number AS found, CAST(sign || value AS DECIMAL(18,3)) AS amount,
               {_feed_reason("m.is_customer_number_active", "m.account_number")}
        FROM ({SQL["decode_points"]}) p LEFT JOIN fx_master m
             ON p.product_company = m.product_company AND p.account_number = m.account_number""",
    "amount",
    "0",
    "product_company, NULL, transaction_id, transaction_date, loyalty_program_cod, "
    "CAST(transaction_value AS VARCHAR), value",
    f"product_company, found, {_feed_id()}, transaction_date, loyalty_program_cod, "
    f"{_MONEY.format('transaction_value', 2)}, {_MONEY.format('value', 3)}",
)

_BAD_LINES = """UNION ALL SELECT 'rejected_lines', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    concat_ws(';', appcode, product_company, {customer}, transaction_id, transaction_date, transaction_type, sign,
              currency, value, causal, causalcode, internallog_ts), 'field count'
FROM {table} WHERE causal LIKE '%;%'"""

SQL["feed_partner"] = _fed(
    f"""SELECT f.*, m.customer_number AS found, TRY_CAST(concat(sign, value) AS DECIMAL(18,3)) AS amount,
               TRY_CAST(value AS BIGINT) AS sent, {_feed_reason("m.is_customer_number_active", "m.account_number")}
        FROM (SELECT * FROM fx_partner WHERE causal NOT LIKE '%;%') f LEFT JOIN {_BY_ACCOUNT}""",
    "CASE WHEN transaction_type = 'VC' THEN amount * 0.001 ELSE 0 END",
    "CASE WHEN transaction_type = 'E' THEN amount ELSE 0 END",
    "product_company, account_number, transaction_id, transaction_date, NULL, NULL, value",
    f"product_company, found, {_feed_id()}, transaction_date, '0', "
    + _MONEY.format("CASE WHEN transaction_type = 'VC' THEN sent // 10 ELSE sent * 100 END", 2)
    + ", "
    + _MONEY.format("CASE WHEN transaction_type = 'VC' THEN sent // 1000 ELSE sent * 100 END", 3),
    _BAD_LINES.format(table="fx_partner", customer="account_number"),
)

SQL["feed_saveback"] = _fed(
    f"""SELECT f.*, c.customer_number AS found, CAST(concat(sign, value) AS DECIMAL(18,3)) AS amount,
               {_feed_reason("c.active", "c.customer_number", "CAST(transaction_id AS BIGINT) % 3 = 0")}
        FROM (SELECT * FROM fx_movement WHERE causal NOT LIKE '%;%') f
        LEFT JOIN (SELECT product_company, customer_number, bool_or(is_customer_number_active) AS active
                   FROM fx_master GROUP BY product_company, customer_number) c
             ON f.product_company = c.product_company AND f.customer_number = c.customer_number""",
    "CASE WHEN transaction_type = 'VC' THEN amount ELSE 0 END",
    "CASE WHEN transaction_type = 'E' THEN amount ELSE 0 END",
    "product_company, customer_number, transaction_id, transaction_date, NULL, NULL, value",
    f"product_company, found, {_feed_id()}, transaction_date, '', '0.00', {_MONEY.format('value', 3)}",
    _BAD_LINES.format(table="fx_movement", customer="customer_number")
    + f"""
UNION ALL SELECT 'l_transaction', product_company, customer_number, {_feed_id()}, transaction_date, loyalty_program_cod,
    {_MONEY.format("transaction_value", 2)}, {_MONEY.format("value", 3)}, NULL, NULL, NULL, NULL
FROM fx_movement WHERE CAST(transaction_id AS BIGINT) % 3 = 0""",
)

SQL["feed_enrolment"] = f"""
WITH wide AS ({SQL["pivot_enrolment"]}),
staged AS (SELECT product_company, customer_number, account_number,
                  CASE WHEN EXISTS (SELECT 1 FROM fx_master m WHERE m.product_company = w.product_company
                                    AND m.account_number = w.account_number) THEN 'already in master'
                       WHEN count(*) OVER (PARTITION BY product_company, account_number) > 1 THEN 'repeated account' END AS reason
           FROM wide w)
SELECT 'l_anag' AS table_name, product_company, customer_number, account_number, account_status,
       CAST(NULL AS VARCHAR) AS balance_extrabonus, CAST(NULL AS VARCHAR) AS balance_virtualcredit, CAST(NULL AS VARCHAR) AS reason
FROM fx_anag
UNION ALL SELECT 'l_anag', product_company, customer_number, account_number, '', NULL, NULL, NULL FROM staged WHERE reason IS NULL
UNION ALL SELECT 'i_feed', product_company, customer_number, account_number, '', NULL, NULL, NULL FROM staged WHERE reason IS NULL
UNION ALL SELECT 'i_feed_rejected', product_company, customer_number, account_number, '', NULL, NULL, reason
FROM staged WHERE reason IS NOT NULL
UNION ALL SELECT 'l_balance', product_company, customer_number, NULL, NULL, CAST(balance_extrabonus AS VARCHAR),
       CAST(balance_virtualcredit AS VARCHAR), NULL FROM fx_balance
UNION ALL SELECT DISTINCT 'l_balance', product_company, customer_number, NULL, NULL, '0.000', '0.000', NULL
FROM staged s WHERE reason IS NULL AND NOT EXISTS (SELECT 1 FROM fx_balance b
     WHERE b.product_company = s.product_company AND b.customer_number = s.customer_number)"""

SQL["feed_maintenance"] = f"""
WITH pivoted AS ({_PIVOTED}),
routed AS (SELECT p.*, m.customer_number AS found, {_RULE} AS action_rule
           FROM pivoted p LEFT JOIN fx_anag m ON m.product_company = '18200' AND m.account_number = p.key_id),
closing AS (SELECT found, min(plastic_status_new) AS status FROM routed WHERE found IS NOT NULL AND action_rule = 2 GROUP BY found),
zero AS (SELECT count(*) > 0 AS any_closed FROM closing)
SELECT 'l_anag' AS table_name, a.product_company, a.customer_number, a.account_number,
       coalesce(c.status, a.account_status) AS account_status,
       CAST(NULL AS VARCHAR) AS balance_extrabonus, CAST(NULL AS VARCHAR) AS balance_virtualcredit, CAST(NULL AS VARCHAR) AS reason
FROM fx_anag a LEFT JOIN closing c ON a.product_company = '18200' AND a.customer_number = c.found
UNION ALL
SELECT 'l_balance', b.product_company, b.customer_number, NULL, NULL,
       CAST(CASE WHEN c.found IS NOT NULL THEN CAST(0 AS DECIMAL(18,3)) WHEN any_closed THEN coalesce(balance_extrabonus, 0)
                 ELSE balance_extrabonus END AS VARCHAR),
       CAST(CASE WHEN c.found IS NOT NULL THEN CAST(0 AS DECIMAL(18,3)) WHEN any_closed THEN coalesce(balance_virtualcredit, 0)
                 ELSE balance_virtualcredit END AS VARCHAR), NULL
FROM fx_balance b LEFT JOIN closing c ON b.product_company = '18200' AND b.customer_number = c.found CROSS JOIN zero
UNION ALL SELECT 'i_feed', '18200', found, key_id, '', NULL, NULL, NULL FROM routed WHERE found IS NOT NULL
UNION ALL SELECT 'i_feed_rejected', '18200', NULL, key_id, '', NULL, NULL, 'unknown account' FROM routed WHERE found IS NULL"""

SQL["decoded_load"] = """
SELECT appcode, product_company, customer_number, transaction_id, transaction_date, transaction_type, sign, currency, value,
       causal, causalcode, input_filename, input_filename_timestamp, elaboration_ts, internallog_ts,
       CAST(NULL AS VARCHAR) AS line, CAST(NULL AS VARCHAR) AS reason
FROM fx_movement WHERE causal NOT LIKE '%;%'
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       concat_ws(';', appcode, product_company, customer_number, transaction_id, transaction_date, transaction_type, sign,
                 currency, value, causal, causalcode, input_filename, input_filename_timestamp, elaboration_ts,
                 internallog_ts), 'field count'
FROM fx_movement WHERE causal LIKE '%;%'"""

# ---- table maintenance -----------------------------------------------------

SQL["feed_reset"] = """
SELECT 'p_partner' AS table_name, appcode, product_company, customer_number, transaction_id, transaction_date,
       transaction_type, sign, currency, value, causal, causalcode, input_filename, input_filename_timestamp,
       elaboration_ts, internallog_ts
FROM fx_movement"""

_LEDGERS = f"""
SELECT 'l_anag' AS table_name, product_company, customer_number, account_number, account_status,
       CAST(NULL AS VARCHAR) AS balance_extrabonus, CAST(NULL AS VARCHAR) AS balance_virtualcredit,
       CAST(NULL AS VARCHAR) AS transaction_id, CAST(NULL AS VARCHAR) AS transaction_date, CAST(NULL AS VARCHAR) AS value
FROM fx_anag
UNION ALL
SELECT 'l_balance', product_company, customer_number, NULL, NULL, CAST(balance_extrabonus AS VARCHAR),
       CAST(balance_virtualcredit AS VARCHAR), NULL, NULL, NULL
FROM fx_balance
UNION ALL
SELECT 'l_transaction', f.product_company, f.customer_number, NULL, NULL, NULL, NULL, {_LEDGER_ID}, f.transaction_date,
       CAST(CAST(f.value AS DECIMAL(18,3)) AS VARCHAR)
FROM fx_movement f"""

SQL["ledger_snapshot"] = _LEDGERS
SQL["ledger_restore"] = _LEDGERS

SQL["table_rewrite"] = "SELECT * FROM fx_feed"

_WITH_COLUMN = """
SELECT appcode, product_company, account_number, customer_number, transaction_id, transaction_date,
       CAST(0 AS INTEGER) AS transaction_value, transaction_type, sign, currency, value, causalcode, input_filename,
       input_filename_timestamp
FROM fx_feed"""

SQL["table_column"] = _WITH_COLUMN
SQL["add_column"] = _WITH_COLUMN


def statements() -> dict[str, str]:
    return {name: with_views(body) for name, body in SQL.items()}

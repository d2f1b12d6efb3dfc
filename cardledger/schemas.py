"""Record layouts of the five feeds and schemas of the stored tables.

Layout positions count from 0 and exclude the end.  Staged text stays text;
amounts in the ledgers are decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DecimalType, StringType, StructField, StructType

Layout = dict[str, tuple[int, int]]

# ---- fixed-width layouts (fixed values) -----------------------------------

ENROLMENT_HEADER: Layout = {
    "issuer_id": (0, 9),
    "header_indicator": (9, 10),
    "sender_id": (10, 19),
    "batch_id": (19, 33),
    "record_counter": (33, 42),
    "sender_code": (76, 81),
    "company": (81, 86),
    "owner1": (86, 91),
    "owner2": (91, 96),
    "owner3": (96, 101),
    "sequence_number": (101, 110),
    "header": (110, 117),
}

ENROLMENT_DETAIL: Layout = {
    "issuer_batch_id": (0, 14),
    "ibr_key": (14, 25),
    "function_id": (25, 35),
    "result": (35, 36),
    "key_of_function": (36, 59),
    "key_type": (59, 60),
    "alias_id": (60, 68),
    "value": (68, 200),
}

POINTS_HEADER: Layout = {
    "record_type": (0, 2),
    "product_company": (2, 7),
    "programme": (22, 27),
    "current_date": (42, 50),
}

POINTS_ACCOUNT_TOTAL: Layout = {
    "record_type": (0, 2),
    "product_company": (2, 7),
    "programme": (22, 27),
    "account_number": (42, 65),
    "effective_date": (65, 72),
    "expiry_date": (72, 79),
    "cycle_end": (197, 204),
    "award_cycle": (204, 211),
    "opening_balance": (211, 226),
    "points_added": (226, 241),
    "closing_balance": (286, 301),
    "cycle_regular_amount": (301, 316),
    "expiry_flag": (331, 332),
}

POINTS_TRANSACTION: Layout = {
    "record_type": (0, 2),
    "product_company": (2, 7),
    "programme": (22, 27),
    "account_number": (42, 65),
    "reference_number": (65, 88),
    "transaction_date": (88, 95),
    "posted_amount": (95, 110),
    "category": (110, 112),
    "currency_number": (112, 115),
    "foreign_amount": (115, 130),
    "points": (130, 145),
    "posting_date": (161, 168),
}

MAINTENANCE_DETAIL: Layout = {
    "key_company": (0, 5),
    "key_type": (5, 6),
    "key_id": (6, 29),
    "created_ts": (29, 55),
    "user_id": (55, 63),
    "maintained_ts": (63, 89),
    "alias_id": (89, 97),
    "maint_type": (97, 98),
    "old_value": (98, 598),
    "new_value": (598, 1098),
}

# Enrolment attribute codes and the master column each one fills.
ENROLMENT_ALIASES = {
    "X11422QZ": "product_company",
    "X1142237": "account_number",
    "X11422W0": "customer_number",
    "X11422PC": "customer_company",
    "X1142239": "full_name",
    "X1142241": "customer_address",
    "X1142244": "customer_city",
    "X1142245": "customer_state",
    "X1142246": "zip",
    "X1142250": "country_cod",
    "X1142247": "date_birth",
    "X1142248": "home_tel",
    "X1142249": "work_tel",
    "X1142251": "taxid_number",
    "X1142252": "document_type",
    "X1142253": "city_birth",
    "X1142254": "gender",
    "X11422BS": "nationality",
    "X11422UW": "email",
    "X11422FS": "loyalty_program_cod",
    "X11422BI": "loyalty_program_status",
}

# ---- stored tables --------------------------------------------------------

# ---- stored tables and files (fixed values: names and order are agreed with the partners) ----


def text_table(names: list[str], **typed: DataType) -> StructType:
    """A schema of text columns, but for those given a type."""
    return StructType([StructField(name, typed.get(name, StringType())) for name in names])


MASTER = text_table(
    [
        "appcode",
        "issuer_id",
        "customer_company",
        "product_company",
        "customer_number",
        "account_number",
        "is_customer_number_active",
        "is_account_number_active",
        "customer_status",
        "account_status",
        "customer_name",
        "customer_surname",
        "customer_address",
        "customer_city",
        "customer_state",
        "zip",
        "country_cod",
        "date_birth",
        "home_tel",
        "work_tel",
        "taxid_number",
        "document_type",
        "city_birth",
        "gender",
        "nationality",
        "email",
        "input_filename",
        "input_filename_timestamp",
        "elaboration_ts",
        "internallog_ts",
    ],
    is_customer_number_active=BooleanType(),
    is_account_number_active=BooleanType(),
)

BALANCE = text_table(
    [
        "customer_company",
        "product_company",
        "customer_number",
        "balance_extrabonus",
        "balance_virtualcredit",
        "elaboration_ts",
    ],
    balance_extrabonus=DecimalType(18, 3),
    balance_virtualcredit=DecimalType(18, 3),
)

TRANSACTION = text_table(
    [
        "appcode",
        "product_company",
        "customer_number",
        "loyalty_program_cod",
        "transaction_id",
        "transaction_date",
        "transaction_value",
        "transaction_type",
        "sign",
        "currency",
        "value",
        "causal",
        "causalcode",
        "input_filename",
        "input_filename_timestamp",
        "elaboration_ts",
        "internallog_ts",
    ],
    transaction_value=DecimalType(18, 2),
    value=DecimalType(18, 3),
)

# Enrolment rows are staged in the shape of the master (30 columns).
STAGED_ENROLMENT = MASTER

STAGED_POINTS = text_table(
    [
        "appcode",
        "product_company",
        "account_number",
        "loyalty_program_cod",
        "transaction_id",
        "transaction_date",
        "transaction_value",
        "transaction_type",
        "sign",
        "currency",
        "value",
        "causal",
        "causalcode",
        "input_filename",
        "input_filename_timestamp",
        "elaboration_ts",
        "internallog_ts",
    ],
    transaction_value=DecimalType(15, 2),
)

STAGED_MAINTENANCE = text_table(
    [
        "appcode",
        "product_company",
        "keytype",
        "customer_number",
        "account_number",
        "customer_status",
        "account_status",
        "input_filename",
        "input_filename_timestamp",
        "elaboration_ts",
        "internallog_ts",
        "plastic_status_old",
        "plastic_status_new",
        "cup_old",
        "cup_new",
        "livrea_old",
        "livrea_new",
        "dealer_old",
        "dealer_new",
        "convenzione_old",
        "convenzione_new",
    ],
)

# The twelve fields of a partner or save-back line, in line order.
MOVEMENT_FIELDS = [
    "appcode",
    "product_company",
    "customer_number",
    "transaction_id",
    "transaction_date",
    "transaction_type",
    "sign",
    "currency",
    "value",
    "causal",
    "causalcode",
    "internallog_ts",
]

STAGED_MOVEMENT = text_table(
    [
        "appcode",
        "product_company",
        "customer_number",
        "transaction_id",
        "transaction_date",
        "transaction_type",
        "sign",
        "currency",
        "value",
        "causal",
        "causalcode",
        "input_filename",
        "input_filename_timestamp",
        "elaboration_ts",
        "internallog_ts",
    ],
)

# Tables of the engine's own: load log, booked batches, lines that are no rows.
LOADED_FILES = text_table(["feed", "input_filename", "internallog_ts", "elaboration_ts"])
BOOKED_BATCHES = text_table(["feed", "source", "elaboration_ts"])
REJECTED_LINES = text_table(["line", "reason", "input_filename", "elaboration_ts"])

# Fields of the two partner files and of the response file, in file order.
ACTION_FILE = [
    "appcode",
    "product_company",
    "customer_number",
    "cup",
    "livrea",
    "convenzione",
    "dealer",
    "plastic_type",
    "customer_name",
    "customer_surname",
    "customer_address",
    "customer_city",
    "customer_state",
    "zip",
    "country_cod",
    "date_birth",
    "home_tel",
    "work_tel",
    "taxid_number",
    "city_birth",
    "gender",
    "nationality",
    "email",
    "data",
    "actionid",
    "action_anagrafica",
    "action_bonus",
    "action_extrabonus",
    "elaboration_ts",
]

TRANSACTION_FILE = [
    "appcode",
    "product_company",
    "customer_number",
    "transaction_id",
    "transaction_date",
    "transaction_value",
    "transaction_type",
    "sign",
    "currency",
    "value",
    "causal",
    "causalcode",
    "elaboration_ts",
]

RESPONSE_FILE = [
    "appcode",
    "product_company",
    "customer_number",
    "transaction_id",
    "transaction_date",
    "transaction_type",
    "sign",
    "currency",
    "value",
    "causal",
    "causalcode",
    "input_filename_timestamp",
    "response_code",
    "response_text",
]


def conform(rows: DataFrame, schema: StructType) -> DataFrame:
    """Project to a table's column order; a missing column or another type is an error."""
    present = dict(rows.dtypes)
    wrong = [
        f"{field.name}: {present.get(field.name, 'missing')} instead of {field.dataType.simpleString()}"
        for field in schema.fields
        if present.get(field.name) != field.dataType.simpleString()
    ]
    if wrong:
        raise ValueError("schema mismatch: " + "; ".join(wrong))
    return rows.select(*[F.col(name) for name in schema.names])

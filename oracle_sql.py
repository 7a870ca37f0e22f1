"""DuckDB SQL equivalents of every registered query (the correctness oracle).

Each cleaner is written a second time as a DuckDB expression, independently
of the Spark code, from the rule it implements.  The queries share one CTE
chain: the dirty fixture, the one-row-per-customer table, the id filter, the
name rebuild and the clean table.
"""

from __future__ import annotations

from ledgerlint.functions import lookups as L
from ledgerlint.sources.fixture import fixture_sql

# Python whitespace / word / digit classes written for RE2.
WS = r"\t\n\x0B\f\r\x1C-\x1F\p{Z}\x{85}"
NOT_WORD_WS = r"[^\p{L}\p{N}_" + WS + "]"
CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def case_map(expr: str, pairs) -> str:
    return "CASE " + expr + " " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in pairs) + " END"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def spark_initcap(x: str) -> str:
    """Spark initcap: lower everything, upper the first letter after each space."""
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def py_title(x: str) -> str:
    runs = f"regexp_extract_all({x}, '[{CASED}]+|[^{CASED}]+')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || lower(r[2:])), '')"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({strip(x)}, '[{WS}]+'), lambda t: t <> '')"


def digits(x: str) -> str:
    return f"regexp_replace({x}, '[^\\p{{Nd}}]', '', 'g')"


# --- cleaners ----------------------------------------------------------------
def c_id(x):
    return f"CASE WHEN regexp_matches({strip(x)}, '^(ID|L)-[\\p{{Nd}}]{{8}}$') THEN {strip(x)} END"


def c_gender(x, null_token="NULL"):
    g = f"lower({strip(x)})"
    other = q(null_token) if null_token is not None else "NULL"
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {g} IN {in_list(L.GENDER_MALE)} THEN 'Male' "
        f"WHEN {g} IN {in_list(L.GENDER_FEMALE)} THEN 'Female' "
        f"WHEN {g} IN {in_list(L.GENDER_NON_BINARY)} THEN 'Non-binary' ELSE {other} END"
    )


def c_name(x, null_token="NULL"):
    other = q(null_token) if null_token is not None else "NULL"
    return (
        f"CASE WHEN regexp_matches({strip(x)}, '^[a-zA-Z]+$') AND {x} NOT IN {in_list(L.EXCLUDE_FIRST + L.EXCLUDE_LAST)} "
        f"THEN {strip(x)} ELSE {other} END"
    )


def c_date(x):
    s = strip(x)
    branches = []
    for gate, py_fmt, _ in L.DATE_FORMATS:
        branches.append(f"WHEN regexp_matches({s}, {q(gate)}) THEN CAST(try_strptime({s}, {q(py_fmt)}) AS DATE)")
    d = "CASE " + " ".join(branches) + " END"
    return f"(CASE WHEN year({d}) >= 1 THEN {d} END)"


def c_age(age, dob_clean):
    s = strip(age)
    a = f"(CASE WHEN regexp_full_match({s}, '[+-]?[0-9]+') THEN TRY_CAST({s} AS INTEGER) END)"
    derived = (
        f"(year(current_date) - year({dob_clean}) - "
        f"CASE WHEN strftime(current_date, '%m%d') < strftime({dob_clean}, '%m%d') THEN 1 ELSE 0 END)"
    )
    return (
        f"CASE WHEN {age} IS NULL THEN NULL WHEN {a} BETWEEN 0 AND 120 THEN {a} "
        f"WHEN {derived} BETWEEN 0 AND 120 THEN CAST({derived} AS INTEGER) END"
    )


def c_email(x):
    return f"CASE WHEN regexp_matches({strip(x)}, {q(L.EMAIL_PATTERN)}) THEN {strip(x)} END"


def c_phone(x):
    d = digits(x)
    return f"CASE WHEN length({d}) = 10 THEN substr({d}, 1, 3) || '-' || substr({d}, 4, 3) || '-' || substr({d}, 7, 4) END"


def c_state(x):
    return case_map(f"upper({x})", L.state_pairs())


def c_address(x):
    return spark_initcap(f"regexp_replace(trim({x}), '[^a-zA-Z0-9 \\t\\n\\x0B\\f\\r,.-]', '', 'g')")


def c_city(x):
    return spark_initcap(f"regexp_replace(trim({x}), '[^a-zA-Z \\t\\n\\x0B\\f\\r]', '', 'g')")


def c_zip(x, empty_as_null=False):
    z = f"regexp_extract(regexp_replace({x}, '[^0-9]', '', 'g'), '([0-9]{{5}})', 1)"
    z = f"NULLIF({z}, '')" if empty_as_null else z
    return f"CASE WHEN {x} IS NOT NULL THEN {z} END"


def c_credit(x):
    e = f"regexp_extract(regexp_replace({x}, '[^0-9]', '', 'g'), '([0-9]{{2,}})', 1)"
    return f"TRY_CAST(CASE WHEN {x} IS NOT NULL THEN {e} END AS INTEGER)"


def c_balance(x, keep_sign=False):
    if keep_sign:
        return f"TRY_CAST({c_amount(x, True)} AS DOUBLE)"
    e = f"regexp_extract(regexp_replace({x}, '[^0-9.]', '', 'g'), '([0-9]*\\.?[0-9]+)', 1)"
    return f"CASE WHEN {x} IS NOT NULL THEN TRY_CAST({e} AS DOUBLE) END"


def c_amount(x, keep_sign=False):
    if keep_sign:
        kept = f"regexp_replace({x}, '[^\\p{{Nd}}.-]', '', 'g')"
        return f"NULLIF(regexp_extract({kept}, '-?[\\p{{Nd}}]*\\.?[\\p{{Nd}}]+', 0), '')"
    kept = f"regexp_replace({x}, '[^\\p{{Nd}}.]', '', 'g')"
    return f"NULLIF(regexp_extract({kept}, '[\\p{{Nd}}]*\\.?[\\p{{Nd}}]+', 0), '')"


def c_account_type(x, intended=False):
    if intended:
        pairs = [(t.upper(), t) for t in L.ACCOUNT_TYPES]
        return f"CASE WHEN {x} = 'Retail' THEN 'Business' WHEN {x} = 'Online' THEN 'Online' ELSE {case_map(f'upper({x})', pairs)} END"
    return f"CASE WHEN upper({x}) = 'CHECKING' THEN 'Checking' WHEN {x} = 'Retail' THEN 'Business' WHEN {x} = 'Online' THEN 'Online' END"


def c_employment(x):
    return case_map(f"lower({strip(x)})", L.employment_pairs())


def c_txn_type(x):
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE coalesce({case_map(strip(x), L.TRANSACTION_TYPES)}, 'Unknown') END"


def c_merchant(x):
    ws = words(f"regexp_replace({x}, '{NOT_WORD_WS}', ' ', 'g')")
    sfx = in_list(L.MERCHANT_SUFFIXES)
    main = f"array_to_string(list_filter({ws}, lambda w: lower(w) NOT IN {sfx}), ' ')"
    last = f"list_filter({ws}, lambda w: lower(w) IN {sfx})[-1]"
    return f"CASE WHEN {x} IS NOT NULL AND {x} <> '' THEN {py_title(main)} || coalesce(' ' || upper({last}), '') END"


def c_category(x):
    v = f"regexp_replace(upper({strip(x)}), '[^A-Z]', '', 'g')"
    return f"CASE WHEN {v} IN {in_list(L.MERCHANT_CATEGORIES)} THEN upper({v}[1]) || lower({v}[2:]) ELSE 'Unknown' END"


def c_payment(x, intended=False):
    v = f"regexp_replace(upper({strip(x)}), '[^A-Z]', '', 'g')"
    pairs = L.PAYMENT_METHODS + (L.PAYMENT_METHODS_INTENDED_EXTRA if intended else [])
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE coalesce({case_map(v, pairs)}, 'Unknown') END"


def c_last_four(x):
    return f"NULLIF(right({digits(x)}, 4), '')"


def c_card_type(x):
    return f"CASE WHEN {x} IS NULL OR {strip(x)} = '' THEN 'Unknown' ELSE coalesce({case_map(strip(x), L.CARD_TYPES)}, 'Other') END"


def c_bool_words(x):
    return f"CASE WHEN lower({x}) IN {in_list(L.TRUE_WORDS)} THEN true WHEN lower({x}) IN {in_list(L.FALSE_WORDS)} THEN false END"


def c_cast_bool(x):
    v = f"lower(trim({x}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))"
    return f"CASE WHEN {v} IN ('t', 'true', 'y', 'yes', '1') THEN true WHEN {v} IN ('f', 'false', 'n', 'no', '0') THEN false END"


def c_text(x):
    return f"regexp_replace(lower({strip(x)}), '[^a-zA-Z0-9]', ' ', 'g')"


# --- the CTE chain -----------------------------------------------------------
def _name_ctes(src: str, key: str, dedup: str) -> str:
    """CTEs 'roles', 'toks', 'tagged', 'parts', 'sfx', 'names' for the C4 rebuild."""
    ws = words(f"regexp_replace(full_name, '{NOT_WORD_WS}', ' ', 'g')")
    return f"""
fdict AS (SELECT DISTINCT lower(first_name) AS name FROM {dedup} WHERE first_name IS NOT NULL),
ldict AS (SELECT DISTINCT lower(last_name) AS name FROM {dedup} WHERE last_name IS NOT NULL),
roles AS (
  SELECT token, min(role) AS role FROM (
    SELECT name AS token, 'F' AS role FROM fdict WHERE name NOT IN {in_list(L.EXCLUDE_FIRST)}
    UNION ALL
    SELECT name AS token, 'L' AS role FROM ldict WHERE name NOT IN {in_list(L.EXCLUDE_LAST)}
  ) GROUP BY token
),
wl AS (SELECT {key} AS k, {ws} AS ws FROM {src}),
toks AS (SELECT k, unnest(generate_series(1, len(ws))) AS pos, unnest(ws) AS tok FROM wl WHERE len(ws) > 0),
tagged AS (
  SELECT t.k, t.pos, t.tok,
         CASE WHEN r.role IS NOT NULL THEN r.role WHEN lower(t.tok) IN {in_list(L.NAME_SUFFIXES)} THEN 'S' END AS role
  FROM toks t LEFT JOIN roles r ON lower(t.tok) = r.token
),
parts AS (
  SELECT k,
         max_by(tok, pos) FILTER (WHERE role = 'F') AS f,
         max_by(tok, pos) FILTER (WHERE role = 'L') AS l,
         max(pos) FILTER (WHERE role = 'L') AS lp
  FROM tagged GROUP BY k
),
sfx AS (
  SELECT t.k, string_agg(' ' || t.tok, '' ORDER BY t.pos) AS s
  FROM tagged t JOIN parts p ON t.k = p.k
  WHERE t.role = 'S' AND t.pos > coalesce(p.lp, -1)
  GROUP BY t.k
),
names AS (
  SELECT p.k, NULLIF({strip("coalesce(p.f, '') || ' ' || coalesce(p.l, '') || coalesce(s.s, '')")}, '') AS full
  FROM parts p LEFT JOIN sfx s ON p.k = s.k
)"""


def _clean_select(src: str = "kept", intended: bool = False, key: str = "customer_id") -> str:
    """The typed clean table from the id-filtered rows joined to the rebuilt names.

    ``intended`` switches every cleaner with an intended-behavior option to it.
    """
    tok = None if intended else "NULL"
    dob = c_date("r.dob")
    cols = {
        "customer_id": c_id("r.customer_id"),
        "first_name": c_name("r.first_name", tok),
        "last_name": c_name("r.last_name", tok),
        "full_name": "n.full",
        "gender": c_gender("r.gender", tok),
        "dob": dob,
        "age": c_age("r.age", dob),
        "email": c_email("r.email"),
        "phone": c_phone("r.phone"),
        "address": c_address("r.address"),
        "city": c_city("r.city"),
        "state": c_state("r.state"),
        "zip_code": c_zip("r.zip_code", intended),
        "credit_score": c_credit("r.credit_score"),
        "annual_income": f"TRY_CAST({c_amount('r.annual_income', intended)} AS DOUBLE)",
        "employment_status": c_employment("r.employment_status"),
        "account_open_date": c_date("r.account_open_date"),
        "account_type": c_account_type("r.account_type", intended),
        "account_balance": c_balance("r.account_balance", intended),
        "transaction_id": c_id("r.transaction_id"),
        "transaction_date": c_date("r.transaction_date"),
        "transaction_amount": f"TRY_CAST({c_amount('r.transaction_amount', intended)} AS DOUBLE)",
        "transaction_type": c_txn_type("r.transaction_type"),
        "merchant_name": c_merchant("r.merchant_name"),
        "merchant_category": c_category("r.merchant_category"),
        "payment_method": c_payment("r.payment_method", intended),
        "card_last_four": c_last_four("r.card_last_four"),
        "card_type": c_card_type("r.card_type"),
        "is_flagged": c_bool_words("r.is_flagged") if intended else c_cast_bool("r.is_flagged"),
        "is_fraud": c_bool_words("r.is_fraud"),
        "risk_score": f"TRY_CAST({c_amount('r.risk_score', intended)} AS DOUBLE)",
        "notes": c_text("r.notes"),
        "internal_comments": c_text("r.internal_comments"),
        "legacy_id": c_id("r.legacy_id"),
    }
    sel = ",\n  ".join(f"{e} AS {c}" for c, e in cols.items())
    return f"SELECT\n  {sel}\nFROM {src} r LEFT JOIN names n ON r.{key} = n.k"


ID_RE = r"^ID-\d{8}$"

RAW_TEXT_COLUMNS = [
    "customer_id", "first_name", "last_name", "full_name", "gender", "dob", "age", "email", "phone", "address",
    "city", "state", "zip_code", "credit_score", "annual_income", "employment_status", "account_open_date",
    "account_type", "account_balance", "transaction_id", "transaction_date", "transaction_amount",
    "transaction_type", "merchant_name", "merchant_category", "payment_method", "card_last_four", "card_type",
    "is_fraud", "is_flagged", "risk_score", "notes", "internal_comments", "legacy_id", "unused_field", "temp_data",
]


ROW_KEYS = ["src_row", "transaction_id", "customer_id", "legacy_id"]
# The order in which whole rows without a row number compare: all columns but the key, nulls first.
WHOLE_ROW = ", ".join(f"{c} ASC NULLS FIRST" for c in RAW_TEXT_COLUMNS if c != "customer_id")
CLEAN_TYPES = {
    "dob": "date", "account_open_date": "date", "transaction_date": "date", "age": "int", "credit_score": "int",
    "annual_income": "double", "account_balance": "double", "transaction_amount": "double", "risk_score": "double",
    "is_flagged": "boolean", "is_fraud": "boolean",
}
TYPED_RAW = (
    "SELECT src_row, customer_id, "
    + ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in ("transaction_amount", "account_balance", "annual_income", "risk_score"))
    + ", TRY_CAST(age AS INTEGER) AS age, TRY_CAST(credit_score AS INTEGER) AS credit_score, card_last_four, card_type, "
    + f"{c_cast_bool('is_fraud')} AS is_fraud, {c_cast_bool('is_flagged')} AS is_flagged, merchant_name FROM raw"
)


def base_ctes(key: str = "customer_id", order: str = "src_row", intended: bool = False) -> str:
    return f"""WITH raw AS ({fixture_sql()}),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM raw WHERE {key} IS NOT NULL
  ) WHERE rn = 1
),
kept AS (SELECT * FROM dedup WHERE regexp_matches(customer_id, '{ID_RE}') AND regexp_matches(transaction_id, '{ID_RE}')),
{_name_ctes("kept", key, "dedup").strip()},
clean AS ({_clean_select(intended=intended, key=key)})
"""


def raw_only(select: str) -> str:
    return f"WITH raw AS ({fixture_sql()})\n{select}"


CLEAN_NAMES = [
    "customer_id", "first_name", "last_name", "full_name", "gender", "dob", "age", "email", "phone", "address",
    "city", "state", "zip_code", "credit_score", "annual_income", "employment_status", "account_open_date",
    "account_type", "account_balance", "transaction_id", "transaction_date", "transaction_amount",
    "transaction_type", "merchant_name", "merchant_category", "payment_method", "card_last_four", "card_type",
    "is_flagged", "is_fraud", "risk_score", "notes", "internal_comments", "legacy_id",
]


def _unpivot_counts(src: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT {q(c)} AS \"column\", CAST({c} AS VARCHAR) AS value FROM {src}" for c in cols
    )


def _describe(src: str, cols, side: str, text: bool) -> str:
    parts = []
    for c in cols:
        v = f"TRY_CAST({c} AS DOUBLE)" if text else f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT {q(c)} AS \"column\", {q(side)} AS side, count({v}) AS count, round(avg({v}), 6) AS mean, "
            f"round(stddev_samp({v}), 6) AS stddev, min({v}) AS min, max({v}) AS max FROM {src}"
        )
    return " UNION ALL ".join(parts)


def _quality_metrics_sql(src: str, cols_types, intended: bool = False) -> str:
    parts = []
    for c, is_str in cols_types:
        e = f"count_if({c} = '')" if is_str else "0"
        w = f"count_if(regexp_matches({c}, '^[ \\t\\n\\x0B\\f\\r]+$'))" if is_str else "0"
        parts.append(
            f"SELECT {q(c)} AS \"column\", count({c}) AS total, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
            f"count(DISTINCT {c}) AS distinct_values, CAST({e} AS BIGINT) AS empty_strings, "
            f"CAST({w} AS BIGINT) AS whitespace_only, count(*) AS _rows FROM {src}"
        )
    u = " UNION ALL ".join(parts)
    valid = "(total - empty_strings - whitespace_only)" if intended else "(total - null_count - empty_strings - whitespace_only)"
    return f"""SELECT "column", total, null_count, distinct_values, empty_strings, whitespace_only,
  {valid} AS valid,
  CAST({valid} AS DOUBLE) / CAST(_rows AS DOUBLE) * 100.0 AS completeness,
  CASE WHEN {valid} > 0 THEN CAST(distinct_values AS DOUBLE) / CAST({valid} AS DOUBLE) * 100.0 ELSE 0.0 END AS uniqueness
FROM ({u})"""


CLEAN_STRING_COLS = [
    c for c in CLEAN_NAMES
    if c not in ("dob", "age", "credit_score", "annual_income", "account_open_date", "account_balance",
                 "transaction_date", "transaction_amount", "is_flagged", "is_fraud", "risk_score")
]


def _business_rules_sql(src: str, absent: frozenset = frozenset()) -> str:
    rules = [
        ("invalid_amounts", "transaction_amount < 0 OR transaction_amount > 100000"),
        ("invalid_transaction_dates", "transaction_date < DATE '1900-01-01' OR transaction_date > current_date"),
        ("invalid_dob_dates", "dob < DATE '1900-01-01' OR dob > current_date"),
        ("invalid_account_dates", "account_open_date < DATE '1900-01-01' OR account_open_date > current_date"),
        ("invalid_ages", "age < 0 OR age > 120"),
        ("invalid_credit_scores", "credit_score < 300 OR credit_score > 850"),
        ("negative_balances", "account_balance < -10000"),
        ("extremely_high_balances", "account_balance > 10000000"),
        ("invalid_risk_scores", "risk_score < 0 OR risk_score > 1"),
        ("invalid_card_last_four", "NOT regexp_matches(card_last_four, '^[0-9]{4}$')"),
    ]
    rules = [(r, "false" if any(c in cond for c in absent) else cond) for r, cond in rules]
    return " UNION ALL ".join(
        f"SELECT {q(r)} AS rule, CAST(count_if({cond}) AS BIGINT) AS violations, "
        f"CAST(count_if({cond}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0 AS violation_pct FROM {src}"
        for r, cond in rules
    )


EDGE = [
    ("amount_gt_10000", "transaction_amount > 10000"),
    ("amount_lt_1", "transaction_amount < 1"),
    ("card_type_unknown", "card_type = 'Unknown'"),
    ("credit_lt_50", "credit_score < 50"),
    ("credit_gt_800", "credit_score > 800"),
    ("age_lt_18", "age < 18"),
    ("age_gt_80", "age > 80"),
    ("balance_lt_0", "account_balance < 0"),
    ("balance_gt_1000000", "account_balance > 1000000"),
    ("is_fraud", "is_fraud = true"),
    ("is_flagged", "is_flagged = true"),
    ("merchant_has_null", "contains(merchant_name, 'null')"),
    ("merchant_blank", "regexp_matches(merchant_name, '^[ \\t\\n\\x0B\\f\\r]*$')"),
]


def oracle() -> dict[str, str]:
    B = base_ctes()
    cols = ", ".join(CLEAN_NAMES)
    o: dict[str, str] = {}

    # sources / sinks: the written data read back, or facts about it
    # CSV cannot tell an empty field from a missing one: both read back as null.
    o["csv_scan"] = raw_only(
        "SELECT src_row, " + ", ".join(f"NULLIF({c}, '') AS {c}" for c in RAW_TEXT_COLUMNS) + " FROM raw"
    )
    o["csv_by_header"] = raw_only(
        "SELECT src_row, "
        + ", ".join(f"CASE WHEN src_row % 2 = 0 THEN NULLIF({c}, '') END AS {c}" if c in ("notes", "city") else f"NULLIF({c}, '') AS {c}" for c in RAW_TEXT_COLUMNS)
        + ", CAST(NULL AS VARCHAR) AS broken_record FROM raw"
    )
    o["table_exists"] = B + "SELECT false AS existed_before, true AS exists_after, count(*) AS rows FROM clean"
    o["align_append"] = B + "SELECT " + ", ".join("CAST(NULL AS VARCHAR) AS notes" if c == "notes" else c for c in CLEAN_NAMES) + " FROM clean"
    o["append_count"] = B + "SELECT count(*) AS rows, count(*) AS appended FROM clean"
    o["load_if_new"] = B + f"SELECT {cols}, 0 AS second_load_appended FROM clean"
    o["data_exists"] = B + """, incoming AS (SELECT customer_id, transaction_id FROM raw
  WHERE customer_id IS NOT NULL AND regexp_matches(customer_id, '^ID-\\d{8}$') AND regexp_matches(transaction_id, '^ID-\\d{8}$'))
SELECT count(*) > 0 AS data_exists, count(*) AS matched_rows FROM incoming i
WHERE EXISTS (SELECT 1 FROM clean c WHERE c.customer_id = i.customer_id AND c.transaction_id = i.transaction_id)"""

    # relational
    o["drop_null_key"] = raw_only("SELECT * FROM raw WHERE customer_id IS NOT NULL")
    o["dedup_by_key"] = B + "SELECT * FROM dedup"
    o["id_filter"] = B + "SELECT * FROM kept"
    o["drop_columns"] = raw_only("SELECT * EXCLUDE (unused_field, temp_data) FROM raw")
    o["drop_empty_rows"] = raw_only(
        "SELECT * FROM (SELECT "
        + ", ".join(c if c in ROW_KEYS else f"CASE WHEN src_row % 43 <> 0 THEN {c} END AS {c}" for c in ["src_row", *RAW_TEXT_COLUMNS])
        + " FROM raw) WHERE NOT ("
        + " AND ".join(f"{c} IS NULL" for c in RAW_TEXT_COLUMNS if c not in ROW_KEYS)
        + ")"
    )
    o["dedup_no_tiebreak"] = base_ctes(order=WHOLE_ROW) + "SELECT * EXCLUDE (src_row) FROM dedup"
    o["create_target"] = B + "SELECT CAST(p AS INTEGER) AS position, c AS \"column\", t AS type, (SELECT count(*) FROM clean) AS rows FROM (VALUES " + ", ".join(
        f"({i}, {q(c)}, {q(CLEAN_TYPES.get(c, 'string'))})" for i, c in enumerate(CLEAN_NAMES)
    ) + ") AS v(p, c, t)"
    o["data_exists_all_columns"] = B + """SELECT count(*) > 0 AS data_exists, count(*) AS matched_rows FROM clean
WHERE customer_id IS NOT NULL AND transaction_id IS NOT NULL AND gender IS NOT NULL AND state IS NOT NULL AND age IS NOT NULL"""
    o["load_batch_skip_whole"] = B + f"SELECT {cols}, 0 AS second_load_appended FROM clean"
    o["load_once"] = B + f"SELECT {cols}, count(*) OVER () AS appended, 0 AS second_load_appended FROM clean"
    o["load_replay"] = base_ctes(order=WHOLE_ROW) + f"SELECT {cols}, 0 AS second_load_appended FROM clean"
    o["clean_all_by_transaction"] = base_ctes(key="transaction_id") + f"SELECT {cols} FROM clean"
    o["typed_cast"] = raw_only(f"SELECT * EXCLUDE (age, credit_score) FROM ({TYPED_RAW})")
    o["name_dictionary"] = B + "SELECT 'first' AS kind, name FROM fdict UNION ALL SELECT 'last' AS kind, name FROM ldict"
    o["hash_sample"] = """SELECT l_orderkey, l_linenumber FROM lineitem
WHERE CAST(('0x' || substr(md5(l_orderkey || '-' || l_linenumber), 1, 8))::BIGINT AS DOUBLE) / CAST(4294967296 AS DOUBLE) < CAST(0.1 AS DOUBLE)"""
    o["sample_validation"] = B + """SELECT * FROM clean
WHERE CAST(('0x' || substr(md5(customer_id), 1, 8))::BIGINT AS DOUBLE) / CAST(4294967296 AS DOUBLE) < least(CAST(100 AS DOUBLE) / CAST((SELECT count(*) FROM clean) AS DOUBLE), CAST(1 AS DOUBLE))"""
    o["sample_exact"] = B + "SELECT * FROM clean ORDER BY md5(customer_id) LIMIT 100"
    o["describe_numeric"] = B + "SELECT * EXCLUDE (side) FROM (" + _describe(
        "clean", ["transaction_amount", "age", "credit_score", "annual_income", "account_balance", "risk_score"], "cleaned", False
    ) + ")"
    o["value_distribution"] = B + f"""SELECT side, "column", value, count, rank FROM (
  SELECT side, "column", value, count,
         CAST(row_number() OVER (PARTITION BY side, "column" ORDER BY count DESC, value ASC NULLS FIRST) AS INTEGER) AS rank
  FROM (
    SELECT side, "column", value, count(*) AS count FROM (
      SELECT 'original' AS side, * FROM ({_unpivot_counts('raw', ['card_type', 'transaction_type', 'employment_status'])})
      UNION ALL
      SELECT 'cleaned' AS side, * FROM ({_unpivot_counts('clean', ['card_type', 'transaction_type', 'employment_status'])})
    ) GROUP BY side, "column", value
  )
) WHERE rank <= 10"""

    # cleaners over every raw row
    R = lambda body: raw_only(f"SELECT src_row, {body} FROM raw")
    o["clean_ids"] = R(f"{c_id('customer_id')} AS customer_id, {c_id('transaction_id')} AS transaction_id, {c_id('legacy_id')} AS legacy_id")
    o["clean_gender"] = R(f"{c_gender('gender')} AS gender")
    o["clean_names"] = R(f"{c_name('first_name')} AS first_name, {c_name('last_name')} AS last_name")
    o["clean_dates"] = R(
        f"{c_date('dob')} AS dob, {c_date('account_open_date')} AS account_open_date, {c_date('transaction_date')} AS transaction_date"
    )
    o["clean_age"] = R(f"{c_age('age', c_date('dob'))} AS age")
    o["clean_email"] = R(f"{c_email('email')} AS email")
    o["clean_phone"] = R(f"{c_phone('phone')} AS phone")
    o["clean_state"] = R(f"{c_state('state')} AS state")
    o["clean_address_city"] = R(f"{c_address('address')} AS address, {c_city('city')} AS city")
    o["clean_zip"] = R(f"{c_zip('zip_code')} AS zip_code")
    o["clean_credit_score"] = R(f"{c_credit('credit_score')} AS credit_score")
    o["clean_balance"] = R(f"{c_balance('account_balance')} AS account_balance")
    o["clean_amounts"] = R(
        f"{c_amount('annual_income')} AS annual_income, {c_amount('transaction_amount')} AS transaction_amount, "
        f"{c_amount('risk_score')} AS risk_score"
    )
    o["clean_account_type"] = R(f"{c_account_type('account_type')} AS account_type")
    o["clean_employment"] = R(f"{c_employment('employment_status')} AS employment_status")
    o["clean_txn_type"] = R(f"{c_txn_type('transaction_type')} AS transaction_type")
    o["clean_merchant"] = R(f"{c_merchant('merchant_name')} AS merchant_name")
    o["clean_category"] = R(f"{c_category('merchant_category')} AS merchant_category")
    o["clean_payment"] = R(f"{c_payment('payment_method')} AS payment_method")
    o["clean_card_last_four"] = R(f"{c_last_four('card_last_four')} AS card_last_four")
    o["clean_card_type"] = R(f"{c_card_type('card_type')} AS card_type")
    o["clean_booleans"] = R(f"{c_bool_words('is_fraud')} AS is_fraud, {c_cast_bool('is_flagged')} AS is_flagged")
    o["clean_text"] = R(f"{c_text('notes')} AS notes, {c_text('internal_comments')} AS internal_comments")
    o["clean_full_name"] = (
        f"WITH raw AS ({fixture_sql()}),\n"
        "dedup AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY src_row) AS rn "
        "FROM raw WHERE customer_id IS NOT NULL) WHERE rn = 1),\n"
        + _name_ctes("raw", "src_row", "dedup").strip()
        + "\nSELECT r.src_row, n.full AS full_name FROM raw r LEFT JOIN names n ON r.src_row = n.k"
    )

    # the whole job
    o["clean_all"] = B + f"SELECT {cols} FROM clean"
    o["clean_all_intended"] = B + f", clean_i AS ({_clean_select(intended=True)})\nSELECT {cols} FROM clean_i"

    # quality reports
    o["null_profile"] = B + " UNION ALL ".join(
        f"SELECT {q(c)} AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
        f"CAST(count_if({c} IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0 AS null_pct, count(*) AS total_rows, 34 AS n_columns FROM clean"
        for c in CLEAN_NAMES
    )
    o["null_columns"] = B + "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT {q(c)} AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
        f"CAST(count_if({c} IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0 AS null_pct, count(*) AS total_rows, 34 AS n_columns FROM clean"
        for c in CLEAN_NAMES
    ) + ") WHERE null_count > 0"
    o["before_after_counts"] = B + """SELECT o.n AS original_rows, c.n AS cleaned_rows, o.n - c.n AS difference,
  CAST(o.n - c.n AS DOUBLE) / CAST(o.n AS DOUBLE) * 100.0 AS difference_pct
FROM (SELECT count(*) AS n FROM raw) o, (SELECT count(*) AS n FROM clean) c"""
    qm = _quality_metrics_sql("clean", [(c, c in CLEAN_STRING_COLS) for c in CLEAN_NAMES])
    o["quality_metrics"] = B + qm
    o["quality_metrics_intended"] = B + _quality_metrics_sql(
        "clean", [(c, c in CLEAN_STRING_COLS) for c in CLEAN_NAMES], intended=True
    )
    o["quality_flags"] = B + f""", m AS ({qm})
SELECT "column", 'completeness' AS "check", completeness AS value FROM m WHERE completeness < 90
UNION ALL
SELECT "column", 'uniqueness' AS "check", uniqueness AS value FROM m WHERE uniqueness < 80"""
    o["business_rules"] = B + _business_rules_sql("clean")
    o["business_rules_intended"] = base_ctes(intended=True) + _business_rules_sql("clean")
    on_raw = _business_rules_sql("t", {"transaction_date", "dob", "account_open_date"})
    o["business_rules_raw"] = raw_only(f", t AS ({TYPED_RAW}) ").replace("\n, t AS", ", t AS") + on_raw
    o["quality_metrics_signed"] = """WITH s AS (SELECT CASE l_linenumber WHEN 1 THEN CAST('-0' AS DOUBLE) WHEN 2 THEN CAST(0 AS DOUBLE) WHEN 3 THEN CAST(l_tax AS DOUBLE) END AS signed,
  CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN l_returnflag END AS blank, CASE WHEN l_linenumber > 9 THEN l_linenumber END AS empty FROM lineitem)
""" + _quality_metrics_sql("s", [("signed", False), ("blank", True), ("empty", False)])
    o["rule_summary"] = B + f"""SELECT rule, violations, CASE WHEN violations > 0 THEN 'violation' ELSE 'passed' END AS status
FROM ({_business_rules_sql('clean')})"""
    num = ["transaction_amount", "age", "credit_score", "annual_income", "account_balance", "risk_score"]
    o["stat_compare"] = B + _describe("raw", num, "original", True) + " UNION ALL " + _describe("clean", num, "cleaned", False)
    any_edge = " OR ".join(f"({c})" for _, c in EDGE)
    reasons = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN {q(n)} END" for n, c in EDGE) + ")"
    o["edge_cases"] = B + f"SELECT {cols}, {reasons} AS reasons FROM clean WHERE {any_edge} ORDER BY customer_id LIMIT 100"
    o["edge_cases_raw"] = raw_only(f", t AS ({TYPED_RAW}) ").replace("\n, t AS", ", t AS") + f"SELECT src_row, {reasons} AS reasons FROM t WHERE {any_edge} ORDER BY src_row LIMIT 100"
    o["high_value"] = B + f"SELECT {cols} FROM clean WHERE annual_income > 100000 ORDER BY customer_id LIMIT 20"
    o["high_risk"] = B + f"SELECT {cols} FROM clean WHERE risk_score > 0.8 ORDER BY customer_id LIMIT 20"
    o["checkpoint"] = B + " UNION ALL ".join(
        f"SELECT {q(c)} AS \"column\", CAST(count_if({c} IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0 AS null_pct, "
        f"CASE WHEN CAST(count_if({c} IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0 > 50 THEN 'warning' ELSE 'ok' END AS status FROM clean"
        for c in ["customer_id", "transaction_id", "transaction_amount", "transaction_date"]
    )
    # plain tables
    li = [
        ("l_orderkey", False), ("l_partkey", False), ("l_suppkey", False), ("l_linenumber", False),
        ("l_quantity", False), ("l_extendedprice", False), ("l_discount", False), ("l_tax", False),
        ("l_returnflag", True), ("l_linestatus", True), ("l_shipdate", False),
    ]
    orders = [("o_orderkey", False), ("o_custkey", False), ("o_orderstatus", True), ("o_totalprice", False),
              ("o_orderdate", False), ("o_orderpriority", True)]
    customer = [("c_custkey", False), ("c_name", True), ("c_nationkey", False), ("c_acctbal", False), ("c_mktsegment", True)]
    o["null_profile_lineitem"] = " UNION ALL ".join(
        f"SELECT {q(c)} AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
        f"CAST(count_if({c} IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0 AS null_pct, count(*) AS total_rows, {len(li)} AS n_columns FROM lineitem"
        for c, _ in li
    )
    o["quality_metrics_lineitem"] = _quality_metrics_sql("lineitem", li)
    o["quality_metrics_orders"] = _quality_metrics_sql("orders", orders)
    o["quality_metrics_customer"] = _quality_metrics_sql("customer", customer)
    o["describe_numeric_lineitem"] = "SELECT * EXCLUDE (side) FROM (" + _describe(
        "lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "x", False
    ) + ")"
    o["top_values_lineitem"] = f"""SELECT "column", value, count, rank FROM (
  SELECT "column", value, count,
         CAST(row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value ASC NULLS FIRST) AS INTEGER) AS rank
  FROM (SELECT "column", value, count(*) AS count FROM ({_unpivot_counts('lineitem', ['l_returnflag', 'l_linestatus'])})
        GROUP BY "column", value)
) WHERE rank <= 10"""
    return o

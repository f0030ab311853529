"""The named queries in SQL, written on their own for checking the Spark results."""

from __future__ import annotations

from ..fixed_values import ACCOUNTS, BANK_CODES, NOTES, TRANSACTION_LIMITS, UNKNOWN_BANK_CODES


def _values(rows, names: str) -> str:
    quoted = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {quoted}) AS t({names})"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _of_status(status: str, field: int) -> str:
    return _list(a[field] for a in ACCOUNTS if a[3] == status)


_DIMS = f"""
banks AS ({_values(BANK_CODES, "code, name")}),
limits AS (
  SELECT transactionType AS ltype, minAmount, maxAmount,
         CAST(minAmount AS DECIMAL(38,18)) AS lo, CAST(maxAmount AS DECIMAL(38,18)) AS hi
  FROM ({_values(TRANSACTION_LIMITS, "transactionType, minAmount, maxAmount, currency")})
),
accounts AS ({_values(ACCOUNTS, "number, name, bank, status")})"""


def _made(rate: str, seed: int) -> str:
    """Generated rows; sides and faults are chosen by arithmetic on the order key."""

    def party(role: str, index: str, faulty: str) -> str:
        unknown_number = "5000000000 + k % 1000003 * 982451 % 5000000000"

        def field(name: str, position: int, unknown: str) -> str:
            active, inactive = _of_status("ACTIVE", position), _of_status("INACTIVE", position)
            return f"""CASE WHEN {faulty} AND fault = 'inactive' THEN {inactive}[k // 5 % 2 + 1]
                WHEN {faulty} AND fault = 'blocked' THEN {_of_status("BLOCKED", position)}[1]
                WHEN {faulty} AND fault = 'unknown' THEN {unknown}
                ELSE {active}[{index} + 1] END AS {role}{name}"""

        number = f"""CAST(CASE WHEN CAST({unknown_number} AS VARCHAR) IN {tuple(a[0] for a in ACCOUNTS)}
            THEN {unknown_number} + 1 ELSE {unknown_number} END AS VARCHAR)"""
        bank = field("Bank", 2, f"{_list(b[0] for b in BANK_CODES)}[k // 11 % 10 + 1]")
        return f"""{field("Account", 0, number)}, {field("AccountName", 1, "'Unknown Person'")},
            CASE WHEN {faulty} AND fault = 'bank_code' THEN {_list(UNKNOWN_BANK_CODES)}[k // 3 % 5 + 1]
            ELSE {bank.rsplit(" AS ", 1)[0]} END AS {role}BankCode"""

    return f"""
draws AS (
  SELECT id, k, k * 31 % 12 AS s, (k * 31 % 12 + 1 + k * 17 % 11) % 12 AS b, k // 7 % 2 = 0 AS first_side,
    {_list(x[0] for x in TRANSACTION_LIMITS)}[k % 4 + 1] AS transactionType,
    CAST({_list(x[1] for x in TRANSACTION_LIMITS)}[k % 4 + 1] AS BIGINT) AS lo,
    CAST({_list(x[2] for x in TRANSACTION_LIMITS)}[k % 4 + 1] AS BIGINT) AS hi,
    CASE WHEN (k % 1000003 + 1) * 1103515245 % 2147483647 % 1000 < {rate} THEN NULL
      WHEN percent < 30 THEN 'bank_code' WHEN percent < 55 THEN 'inactive'
      WHEN percent < 70 THEN 'blocked' WHEN percent < 90 THEN 'unknown'
      ELSE 'below_minimum' END AS fault
  FROM (SELECT *, (k % 1000003 + 1) * 742938285 % 2147483647 % 100 AS percent
    FROM (SELECT o_orderkey AS id, o_orderkey + {seed} AS k FROM orders))
),
made AS (
  SELECT id, printf('TRX-%07d', id) AS referenceId, {party("source", "s", "first_side")},
    {party("beneficiary", "b", "(NOT first_side)")}, 'IDR' AS currency,
    CAST(CASE WHEN fault = 'below_minimum' THEN 1 + k % 1000003 * 15485863 % (lo - 1)
      ELSE lo + k % 1000003 * 1299709 % (hi - lo + 1) END AS VARCHAR) AS amount,
    transactionType, {_list(NOTES)}[k // 13 % 13 + 1] AS note, fault, hi
  FROM draws
)"""


def _pad(name: str, cases: str = "") -> str:
    return f"CASE WHEN e = 6 THEN '  ' || {name} || '  ' {cases} ELSE {name} END AS {name}"


_RAW = f"""{_made("850", 0)},
raw AS (
  SELECT id, {_pad("referenceId")}, {_pad("sourceAccount", "WHEN e = 4 THEN ''")}, {_pad("sourceAccountName")},
    {_pad("sourceBankCode", "WHEN e = 3 THEN lower(sourceBankCode)")},
    {_pad("beneficiaryAccount", "WHEN e = 5 THEN sourceAccount")}, {_pad("beneficiaryAccountName")},
    {_pad("beneficiaryBankCode", "WHEN e = 3 THEN lower(beneficiaryBankCode)")}, {_pad("currency")},
    {_pad("amount", "WHEN e = 10 THEN (id + 1) || repeat('0', 24) WHEN e = 11 THEN (id + 1) || '.' || repeat('0', 18) || '7' "
                    "WHEN e = 0 THEN 'abc' WHEN e = 1 THEN CAST(hi + 1 AS VARCHAR) "
                    "WHEN e = 8 THEN '9999.99999' WHEN e = 9 THEN ''")},
    {_pad("transactionType", "WHEN e = 2 THEN 'REFUND' WHEN e = 7 THEN lower(transactionType)")}, {_pad("note")}
  FROM (SELECT *, id % 97 AS e FROM made)
)"""

_TEXT_FIELDS = (
    "referenceId", "sourceAccount", "sourceAccountName", "sourceBankCode", "beneficiaryAccount",
    "beneficiaryAccountName", "beneficiaryBankCode", "currency", "transactionType", "note",
)


def _clean(source: str) -> str:
    trimmed = ", ".join(f"trim({f}) AS {f}" for f in _TEXT_FIELDS)
    return f"""
clean AS (
  SELECT * EXCLUDE (written),
    CASE WHEN NOT numeric THEN CAST(0 AS DECIMAL(38,18)) WHEN length(split_part(written, '.', 1)) <= 20
      THEN CAST(regexp_replace(written, '([.][0-9]{{18}})[0-9]+', '\\1') AS DECIMAL(38,18)) END AS amount,
    CASE WHEN numeric THEN written ELSE '0' END AS amount_text
  FROM (SELECT {trimmed}, trim(amount) AS written,
          regexp_full_match(trim(amount), '[0-9]+([.][0-9]+)?') AS numeric FROM {source})
)"""


_LOOKED_UP = """
found AS (
  SELECT c.*, sb.code IS NOT NULL AS sb_known, bb.code IS NOT NULL AS bb_known, l.ltype, l.lo, l.hi, l.minAmount,
    l.maxAmount, sa.number IS NOT NULL AS sa_found, ba.number IS NOT NULL AS ba_found,
    coalesce(upper(sa.status), 'NOT_FOUND') AS s_status, coalesce(upper(ba.status), 'NOT_FOUND') AS own_status,
    '' IN (c.sourceAccount, c.sourceBankCode, c.beneficiaryAccount, c.beneficiaryBankCode) AS no_result
  FROM clean c
  LEFT JOIN banks sb ON upper(sb.code) = upper(c.sourceBankCode)
  LEFT JOIN banks bb ON upper(bb.code) = upper(c.beneficiaryBankCode)
  LEFT JOIN limits l ON upper(l.ltype) = upper(c.transactionType)
  LEFT JOIN accounts sa ON sa.number = c.sourceAccount AND upper(sa.bank) = upper(c.sourceBankCode)
  LEFT JOIN accounts ba ON ba.number = c.beneficiaryAccount AND upper(ba.bank) = upper(c.beneficiaryBankCode)
),
looked AS (
  SELECT *, CASE WHEN sourceAccount = beneficiaryAccount THEN s_status ELSE own_status END AS b_status,
    CASE WHEN ltype IS NULL THEN 'Transaction type ''' || transactionType || ''' is not configured.'
      WHEN amount < lo THEN 'Amount ' || amount_text || ' is below the minimum of ' || minAmount
        || ' for type ''' || transactionType || '''.'
      WHEN amount > hi OR amount IS NULL THEN 'Amount ' || amount_text || ' exceeds the maximum of ' || maxAmount
        || ' for type ''' || transactionType || '''.' END AS amount_reason
  FROM found
),
checked AS (
  SELECT *, validationErrors IS NULL AS valid FROM (
    SELECT *, nullif(concat_ws('; ',
      CASE WHEN NOT sb_known THEN 'sourceBankCode ''' || sourceBankCode || ''' is not a recognised bank code' END,
      CASE WHEN NOT bb_known
        THEN 'beneficiaryBankCode ''' || beneficiaryBankCode || ''' is not a recognised bank code' END,
      CASE WHEN amount_reason IS NOT NULL
        THEN 'amount ' || amount_text || ' is below the minimum for ' || transactionType END,
      CASE WHEN no_result THEN 'account validation service returned no results' END,
      CASE WHEN NOT no_result AND s_status <> 'ACTIVE'
        THEN 'sourceAccount ''' || sourceAccount || ''' is invalid (' || s_status || ')' END,
      CASE WHEN NOT no_result AND b_status <> 'ACTIVE'
        THEN 'beneficiaryAccount ''' || beneficiaryAccount || ''' is invalid (' || b_status || ')' END
    ), '') AS validationErrors FROM looked)
)"""

_FIELDS = (
    "referenceId, sourceAccount, sourceAccountName, sourceBankCode, beneficiaryAccount, beneficiaryAccountName, "
    "beneficiaryBankCode, currency, amount, transactionType, note"
)
_CHECKED_FIELDS = f"{_FIELDS}, amount_text, valid, validationErrors, amount_reason"
_VALID_FIELDS = _FIELDS.replace(" amount,", " amount_text AS amount,")
_INVALID_FIELDS = (
    "referenceId, sourceAccount, sourceBankCode, beneficiaryAccount, beneficiaryBankCode, currency, "
    "amount_text AS amount, transactionType, validationErrors"
)

_CLEAN_CTE = f"WITH {_DIMS.lstrip()}, {_RAW}, {_clean('raw')}"
_CHECKED_CTE = f"{_CLEAN_CTE}, {_LOOKED_UP}"

_CUSTOMER_CTE = f"""
WITH banks AS (SELECT n_name AS code, 'Bank of ' || n_name AS name FROM nation),
limits AS (
  SELECT ltype, '5000' AS minAmount, '400000' AS maxAmount, CAST(5000 AS DECIMAL(38,18)) AS lo,
    CAST(400000 AS DECIMAL(38,18)) AS hi
  FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) AS t(ltype)
),
accounts AS (
  SELECT CAST(c_custkey AS VARCHAR) AS number, c_name AS name, 'NATION_' || (c_custkey % 25) AS bank,
    CASE WHEN c_acctbal < -500 THEN 'BLOCKED' WHEN c_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
  FROM customer
),
paired AS (SELECT *, CASE WHEN o_orderkey % 19 = 6 THEN o_custkey
  ELSE (o_custkey * 31 + 7) % ((SELECT count(*) FROM customer) + 20) END AS bene FROM orders),
raw AS (
  SELECT 'ORD-' || o_orderkey AS referenceId, CAST(o_custkey AS VARCHAR) AS sourceAccount, '' AS sourceAccountName,
    CASE WHEN o_orderkey % 10 = 3 THEN 'nation_' ELSE 'NATION_' END || (o_custkey % 25) AS sourceBankCode,
    CAST(bene AS VARCHAR) AS beneficiaryAccount, '' AS beneficiaryAccountName,
    CASE WHEN o_orderkey % 13 = 5 THEN 'NATION_99' ELSE 'NATION_' || (bene % 25) END AS beneficiaryBankCode, 'IDR' AS currency,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount,
    CASE WHEN o_orderkey % 17 = 4 THEN 'REFUND' ELSE o_orderpriority END AS transactionType, o_orderstatus AS note
  FROM paired
), {_clean('raw')}, {_LOOKED_UP}"""

_SIDES = """sides AS (
  SELECT referenceId, 'source' AS side, sourceAccount AS account, sourceBankCode AS bank FROM clean
  UNION ALL SELECT referenceId, 'beneficiary', beneficiaryAccount, beneficiaryBankCode FROM clean
)"""

_STEPS_CTE = """
WITH counted AS (
  SELECT o_orderkey // 500 + 1 AS run_id, o_orderkey % 500 // 50 AS part, count(*) AS read_count,
    count(*) FILTER (o_orderstatus <> 'P') AS write_count, count(*) FILTER (o_orderstatus = 'P') AS skip_count,
    min(o_orderdate) AS start_time, max(o_orderdate) AS last_time
  FROM orders GROUP BY ALL
),
steps AS (
  SELECT *, CASE WHEN status <> 'STARTED' THEN last_time END AS end_time FROM (
    SELECT *, CASE (run_id * 7 + part * 3) % 41 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'STARTED' WHEN 2 THEN 'STOPPED'
      ELSE 'COMPLETED' END AS status FROM counted)
),
runs AS (
  SELECT run_id, CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED' WHEN bool_or(status = 'STOPPED') THEN 'STOPPED'
      WHEN bool_or(status = 'STARTED') THEN 'STARTED' ELSE 'COMPLETED' END AS status,
    min(start_time) AS start_time, CASE WHEN NOT bool_or(status = 'STARTED') THEN max(end_time) END AS end_time
  FROM steps GROUP BY run_id
)"""

_REQUESTS = """requests AS (
  SELECT CASE WHEN id % 3 = 0 THEN -1 ELSE id // 60 END AS batch_id,
    CASE WHEN id % 3 = 0 THEN 7 ELSE id % 60 * 5 + 1 END AS position,
    trim(sourceAccount) AS account, trim(sourceBankCode) AS bank FROM raw
)"""


def _join_account(side: str) -> str:
    return f"""{_CUSTOMER_CTE} SELECT referenceId, {side}Account, a.name AS account_accountName,
      a.status AS account_status, a.number IS NOT NULL AS account_found
    FROM clean LEFT JOIN accounts a ON a.number = {side}Account AND upper(a.bank) = upper({side}BankCode)"""


def _join_bank(side: str) -> str:
    return f"""{_CUSTOMER_CTE} SELECT referenceId, {side}BankCode, b.name AS bank_name, b.code IS NOT NULL AS bank_known
    FROM clean LEFT JOIN banks b ON upper(b.code) = upper({side}BankCode)"""


def _scientific(digits: str, extra: str) -> str:
    """d.dddE+n for a whole number written with more digits or an exponent."""
    rest = f"CASE WHEN length({digits}) > 1 THEN '.' || substr({digits}, 2) ELSE '' END"
    return f"substr({digits}, 1, 1) || {rest} || 'E' || {extra}"


def _null_if_empty(fields: str) -> str:
    return ", ".join(f"nullif({f.split(' AS ')[0]}, '') AS {f.split(' AS ')[-1]}" for f in fields.split(", "))


_HIT_TEXTS = {
    "inactive": "INACTIVE", "not_found": "NOT_FOUND", "bank_code": "is not a recognised bank code",
    "below_minimum": "is below the minimum", "blocked": "BLOCKED",
}
_RULE_TESTS = {
    "source_bank": "NOT sb_known", "beneficiary_bank": "NOT bb_known", "amount": "amount_reason IS NOT NULL",
    "account_lookup": "no_result", "source_account": "NOT no_result AND s_status <> 'ACTIVE'",
    "beneficiary_account": "NOT no_result AND b_status <> 'ACTIVE'",
}


def _counted(cte: str, name: str, tests: dict[str, str], source: str) -> str:
    lines = " UNION ALL ".join(
        f"SELECT '{key}' AS {name}, count(*) FILTER ({test}) AS hits FROM {source}" for key, test in tests.items()
    )
    return f"{cte} {lines}"


# Orders with smaller keys come before a line, so its range follows from their number.
def _part(ranges: int, rows: str = "checked") -> str:
    return f"""CAST((SELECT count(*) FROM orders o WHERE o.o_orderkey < CAST(substr({rows}.referenceId, 5) AS BIGINT))
    // CAST(ceil((SELECT count(*) FROM orders) / {ranges}) AS BIGINT) AS INTEGER)"""


_PART = _part(10)
_N = "CAST(id + 1 AS VARCHAR)"
_ORACLE = {
    "scan_transactions": f"{_CUSTOMER_CTE} SELECT {_null_if_empty(_FIELDS)} FROM raw",
    "list_bank_codes": "SELECT n_name AS code, 'Bank of ' || n_name AS name FROM nation",
    "list_limits": """SELECT DISTINCT o_orderpriority AS transactionType, '5000' AS minAmount, '400000' AS maxAmount,
        'IDR' AS currency FROM orders""",
    "list_accounts": """SELECT CAST(c_custkey AS VARCHAR) AS accountNumber, c_name AS accountName,
        'NATION_' || (c_custkey % 25) AS bankCode, CASE WHEN c_acctbal < -500 THEN 'BLOCKED'
        WHEN c_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status FROM customer""",
    "gen_transactions": f"WITH {_made('850', 0)} SELECT {_FIELDS}, fault FROM made",
    "fault_mix": f"WITH {_made('750', 11)} SELECT fault, count(*) AS n FROM made GROUP BY fault",
    "cleanse_transactions": f"""{_CLEAN_CTE} SELECT {_FIELDS}, amount_text, TRUE AS valid,
        CAST(NULL AS VARCHAR) AS validationErrors FROM clean""",
    "parse_amount": f"""SELECT id, written, CAST(CASE f WHEN 2 THEN {_N} || '.50' WHEN 3 THEN '0.' || {_N}
          WHEN 5 THEN {_N} || '000' WHEN 6 THEN '0' WHEN 7 THEN '-' || {_N} WHEN 8 THEN '0.0000000' || {_N}
          WHEN 9 THEN NULL ELSE {_N} END AS DECIMAL(38,18)) AS amount,
        CASE f WHEN 2 THEN {_N} || '.50' WHEN 3 THEN '0.' || {_N} WHEN 5 THEN
          {_scientific(_N, f"'+' || (length({_N}) + 2)")} WHEN 6 THEN '0' WHEN 7 THEN '-' || {_N}
          WHEN 8 THEN {_scientific(_N, "'-8'")} WHEN 9 THEN {_N} || repeat('0', 20)
          WHEN 10 THEN {_N} || '.' || repeat('0', 18) || '1' ELSE {_N} END AS amount_text,
        CASE f WHEN 9 THEN 1 WHEN 10 THEN 1 ELSE 0 END AS amount_rest
      FROM (SELECT o_orderkey AS id, o_orderkey % 11 AS f, CASE o_orderkey % 11
          WHEN 0 THEN n WHEN 1 THEN '+' || n WHEN 2 THEN '000' || n || '.50' WHEN 3 THEN '.' || n
          WHEN 4 THEN n || '.' WHEN 5 THEN n || 'e3' WHEN 6 THEN 'abc' || n WHEN 7 THEN '-' || n
          WHEN 8 THEN '0.0000000' || n
          WHEN 10 THEN n || '.' || repeat('0', 18) || '1' ELSE n || repeat('0', 20) END AS written
        FROM (SELECT o_orderkey, CAST(o_orderkey + 1 AS VARCHAR) AS n FROM orders))""",
    "account_key": f"""{_CLEAN_CTE} SELECT referenceId, sourceAccount || ':' || upper(sourceBankCode) AS source_key,
        beneficiaryAccount || ':' || upper(beneficiaryBankCode) AS beneficiary_key FROM clean""",
    "join_source_bank": _join_bank("source"),
    "join_beneficiary_bank": _join_bank("beneficiary"),
    "join_source_account": _join_account("source"),
    "join_beneficiary_account": _join_account("beneficiary"),
    "same_account_override": f"""{_CUSTOMER_CTE} SELECT referenceId, sourceAccount = beneficiaryAccount AS same_account,
        sourceBankCode, beneficiaryBankCode, s_status AS source_status, b_status AS beneficiary_status
        FROM checked""",
    "limit_by_type": """SELECT DISTINCT o_orderpriority AS transactionType, '5000' AS minAmount,
        '400000' AS maxAmount, 'IDR' AS currency FROM orders WHERE upper(o_orderpriority) = '2-HIGH'""",
    "unknown_banks_anti": f"""{_CUSTOMER_CTE}, {_SIDES} SELECT referenceId, side, bank FROM sides
        WHERE NOT EXISTS (SELECT 1 FROM banks WHERE upper(code) = upper(bank))""",
    "known_accounts_semi": f"""{_CUSTOMER_CTE}, {_SIDES} SELECT referenceId, side, account FROM sides s
        WHERE EXISTS (SELECT 1 FROM accounts a WHERE a.number = s.account AND upper(a.bank) = upper(s.bank))""",
    "validate_bank_code": f"""{_CUSTOMER_CTE}, {_SIDES} SELECT referenceId, side, coalesce(b.code, bank) AS code,
        b.code IS NOT NULL AS valid, b.name FROM sides LEFT JOIN banks b ON upper(b.code) = upper(bank)""",
    "validate_amount": f"""{_CHECKED_CTE} SELECT referenceId, transactionType, amount, amount_text,
        amount_reason IS NULL AS valid, amount_reason AS reason FROM checked""",
    "validate_account": f"""{_CUSTOMER_CTE}, {_SIDES} SELECT referenceId, side, account AS accountNumber,
        coalesce(a.bank, s.bank) AS bankCode, a.name AS accountName, coalesce(a.status = 'ACTIVE', FALSE) AS valid,
        coalesce(a.status, 'NOT_FOUND') AS status,
        CASE WHEN a.number IS NULL THEN 'Account number ''' || account || ''' not found for bank ''' || s.bank || '''.'
          WHEN a.status <> 'ACTIVE' THEN 'Account is ' || a.status || '.' END AS reason
        FROM sides s LEFT JOIN accounts a ON a.number = account AND upper(a.bank) = upper(s.bank)""",
    "bulk_account_summary": f"""{_CLEAN_CTE}, {_REQUESTS}, grouped AS (
          SELECT batch_id, count(*) <= 100 AND bool_and(account <> '' AND r.bank <> '') AS accepted,
            count(*) AS n, count(*) FILTER (a.status = 'ACTIVE') AS ok,
            string_agg(account || ':' || coalesce(a.bank, r.bank) || ':' || coalesce(a.status, 'NOT_FOUND'), '|'
              ORDER BY position) AS lines
          FROM requests r LEFT JOIN accounts a ON a.number = account AND upper(a.bank) = upper(r.bank)
          GROUP BY batch_id)
        SELECT batch_id, accepted, n AS totalRequested, CASE WHEN accepted THEN ok END AS totalValid,
          CASE WHEN accepted THEN n - ok END AS totalInvalid, CASE WHEN accepted THEN lines END AS results
        FROM grouped""",
    "contract_batch_size": f"""{_CLEAN_CTE}, {_REQUESTS} SELECT batch_id, count(*) AS size,
        count(*) FILTER (account = '' OR bank = '') AS blank_entries,
        count(*) <= 100 AND count(*) FILTER (account = '' OR bank = '') = 0 AS accepted
        FROM requests GROUP BY batch_id""",
    "contract_blank_fields": f"""{_CHECKED_CTE} SELECT referenceId, sourceAccount, sourceBankCode, beneficiaryAccount,
        beneficiaryBankCode, validationErrors FROM checked WHERE no_result""",
    "validate_transactions": f"{_CHECKED_CTE} SELECT {_CHECKED_FIELDS} FROM checked",
    "validate_transactions_customers": f"{_CUSTOMER_CTE} SELECT {_CHECKED_FIELDS} FROM checked",
    "rule_hits": _counted(_CUSTOMER_CTE, "rule", _RULE_TESTS, "checked"),
    "valid_output": f"{_CUSTOMER_CTE} SELECT {_VALID_FIELDS} FROM checked WHERE valid",
    "invalid_output": f"{_CUSTOMER_CTE} SELECT {_INVALID_FIELDS} FROM checked WHERE NOT valid",
    "written_outputs": f"""{_CUSTOMER_CTE} SELECT {_null_if_empty(_VALID_FIELDS)},
          CAST(NULL AS VARCHAR) AS validationErrors, 'valid' AS outcome, {_PART} AS partition FROM checked WHERE valid
        UNION ALL BY NAME SELECT {_null_if_empty(_INVALID_FIELDS)}, 'invalid' AS outcome, {_PART} AS partition
        FROM checked WHERE NOT valid""",
    "resumed_ranges": f"""{_CUSTOMER_CTE}, placed AS (SELECT *, {_part(7)} AS partition FROM checked)
        SELECT {_null_if_empty(_VALID_FIELDS)}, CAST(NULL AS VARCHAR) AS validationErrors, 'valid' AS outcome, partition,
          partition < 4 AS files_kept, CASE WHEN partition < 4 THEN 1 ELSE 2 END AS execution FROM placed WHERE valid
        UNION ALL BY NAME SELECT {_null_if_empty(_INVALID_FIELDS)}, 'invalid' AS outcome, partition,
          partition < 4 AS files_kept, CASE WHEN partition < 4 THEN 1 ELSE 2 END AS execution FROM placed WHERE NOT valid""",
    "committed_outputs": f"""{_CUSTOMER_CTE} SELECT {_null_if_empty(_VALID_FIELDS)}, CAST(NULL AS VARCHAR) AS validationErrors,
          'valid' AS outcome, {_PART} AS partition, 'COMPLETED FAILED STOPPED' AS states FROM checked WHERE valid
        UNION ALL BY NAME SELECT {_null_if_empty(_INVALID_FIELDS)}, 'invalid' AS outcome, {_PART} AS partition,
          'COMPLETED FAILED STOPPED' AS states FROM checked WHERE NOT valid""",
    "block_chunks": f"""{_CUSTOMER_CTE} SELECT {_VALID_FIELDS}, validationErrors,
        CASE WHEN valid THEN 'valid' ELSE 'invalid' END AS outcome FROM checked""",
    "line_accounting": """SELECT count(*) + left_out AS line_count, left_out, count(*) AS total_read,
          count(*) FILTER (o_orderkey % 5 <> 2) AS total_written, count(*) FILTER (o_orderkey % 5 = 2) AS total_skipped
        FROM orders, (SELECT count(*) AS left_out FROM orders WHERE o_orderkey % 5 IN (0, 1)) GROUP BY left_out""",
    "stream_validate": f"""{_CUSTOMER_CTE} SELECT {_VALID_FIELDS}, validationErrors,
        CASE WHEN valid THEN 'valid' ELSE 'invalid' END AS outcome FROM checked""",
    "output_counts": f"""{_CUSTOMER_CTE}, placed AS (
          SELECT CASE WHEN valid THEN 'valid' ELSE 'invalid' END AS outcome, {_PART} AS p FROM checked)
        SELECT outcome, p AS partition, count(*) AS n FROM placed GROUP BY ROLLUP (outcome, p)""",
    "reconcile_outputs": f"""{_CUSTOMER_CTE} SELECT count(*) AS input_rows, count(*) FILTER (valid) AS valid_rows,
        count(*) FILTER (NOT valid) AS invalid_rows, CAST(0 AS BIGINT) AS lost, CAST(0 AS BIGINT) AS repeated,
        CAST(0 AS BIGINT) AS in_both FROM checked""",
    "resume_anti_join": f"""{_CLEAN_CTE} SELECT referenceId, sourceAccount FROM clean WHERE referenceId NOT IN
        (SELECT printf('TRX-%07d', o_orderkey) FROM orders WHERE o_orderstatus = 'F')""",
    "validity_totals": f"""{_CUSTOMER_CTE} SELECT count(*) AS total, count(*) FILTER (valid) AS valid_rows,
        count(*) FILTER (NOT valid) AS invalid_rows FROM checked""",
    "input_count": "SELECT count(*) AS input_rows FROM orders",
    "errors_by_type": _counted(
        _CHECKED_CTE, "error_type",
        {key: f"contains(validationErrors, '{text}')" for key, text in _HIT_TEXTS.items()}, "checked",
    ),
    "error_histogram": f"""{_CUSTOMER_CTE} SELECT validationErrors, count(*) AS n FROM checked WHERE NOT valid
        GROUP BY validationErrors""",
    "preview_invalid": f"{_CHECKED_CTE} SELECT {_INVALID_FIELDS}, CAST(row_number() OVER (ORDER BY referenceId) AS INTEGER) AS rank FROM checked WHERE NOT valid ORDER BY referenceId LIMIT 4",
    "run_progress": f"""{_STEPS_CTE} SELECT run_id, count(*) AS total_partitions,
        count(*) FILTER (status = 'COMPLETED') AS completed, count(*) FILTER (status = 'STARTED') AS running,
        count(*) FILTER (status = 'FAILED') AS failed, CAST(sum(read_count) AS BIGINT) AS total_read,
        CAST(sum(write_count) AS BIGINT) AS total_written, CAST(sum(skip_count) AS BIGINT) AS total_skipped,
        CAST(0 AS BIGINT) AS total_filtered FROM steps GROUP BY run_id""",
    "run_partitions": f"""{_STEPS_CTE} SELECT run_id, 'partition-' || part AS partition_name, status, read_count,
        write_count, skip_count, CAST(0 AS BIGINT) AS filter_count, CAST(start_time AS VARCHAR) AS start_time,
        CAST(end_time AS VARCHAR) AS end_time,
        CAST(row_number() OVER (ORDER BY 'partition-' || part) AS INTEGER) AS rank FROM steps WHERE run_id = 1""",
    "logged_run": """WITH placed AS (
          SELECT o_orderkey % 10 IN (2, 4) AS skipped, (row_number() OVER (ORDER BY o_orderkey) - 1)
            // CAST(ceil((SELECT count(*) FROM orders) / 10) AS BIGINT) AS p FROM orders)
        SELECT 'COMPLETED' AS run_status, CAST(sum(count(*)) OVER () AS BIGINT) AS total_read,
          CAST(sum(count(*) FILTER (NOT skipped)) OVER () AS BIGINT) AS total_written,
          CAST(sum(count(*) FILTER (skipped)) OVER () AS BIGINT) AS total_skipped, 'partition-' || p AS partition_name,
          count(*) AS read_count, count(*) FILTER (NOT skipped) AS write_count, count(*) FILTER (skipped) AS skip_count
        FROM placed GROUP BY p""",
    "runs_latest": f"{_STEPS_CTE} SELECT run_id, status FROM runs",
    "stoppable_runs": f"{_STEPS_CTE} SELECT run_id, status FROM runs WHERE status IN ('STARTED', 'STARTING')",
    "restartable_runs": f"{_STEPS_CTE} SELECT run_id, status FROM runs WHERE status IN ('STOPPED', 'FAILED')",
    "run_elapsed": f"""{_STEPS_CTE} SELECT run_id, datediff('second', start_time,
        coalesce(end_time, TIMESTAMP '2030-01-01 00:00:00')) || 's' AS elapsed FROM runs""",
    "range_split": """SELECT o_orderkey AS id, CAST((row_number() OVER (ORDER BY o_orderkey) - 1)
        // CAST(ceil((SELECT count(*) FROM orders) / 7) AS BIGINT) AS INTEGER) AS partition FROM orders""",
    "range_bounds": """SELECT p * size + 2 AS startLine, least(p * size + size + 1, n + 1) AS endLine,
          CAST(p AS INTEGER) AS partition
        FROM (SELECT n, CAST(ceil(n / 7) AS BIGINT) AS size, unnest(range(0, 7)) AS p
          FROM (SELECT count(*) AS n FROM orders)) WHERE p * size + 2 <= n + 1""",
    "dim_first_wins": """SELECT upper(c_mktsegment) AS segment, arg_min(c_name, c_custkey) AS name,
        min(c_custkey) AS ord FROM customer GROUP BY 1""",
    "duplicate_accounts": """SELECT CAST(c_nationkey AS VARCHAR) AS accountNumber, upper(c_mktsegment) AS bankKey,
        count(*) AS copies FROM customer GROUP BY ALL HAVING count(*) > 1""",
}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLE)

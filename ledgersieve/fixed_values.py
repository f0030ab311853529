"""Constants that results must reproduce exactly.

Everything here is data, not logic: header names, column orders, message texts,
the seeded reference rows and the generator's word lists and weights.
"""

# --- transaction file -------------------------------------------------------

CSV_HEADER = (
    "Reference ID", "Source Account", "Source Account Name", "Source Bank Code",
    "Beneficiary Account", "Beneficiary Account Name", "Beneficiary Bank Code",
    "Currency", "Amount", "Transaction Type", "Note",
)

TRANSACTION_FIELDS = (
    "referenceId", "sourceAccount", "sourceAccountName", "sourceBankCode",
    "beneficiaryAccount", "beneficiaryAccountName", "beneficiaryBankCode",
    "currency", "amount", "transactionType", "note",
)

INVALID_OUTPUT_FIELDS = (
    "referenceId", "sourceAccount", "sourceBankCode",
    "beneficiaryAccount", "beneficiaryBankCode",
    "currency", "amount", "transactionType", "validationErrors",
)

# --- message texts ({} marks a value) ---------------------------------------

ERROR_SEPARATOR = "; "
SOURCE_BANK_ERROR = "sourceBankCode '{}' is not a recognised bank code"
BENEFICIARY_BANK_ERROR = "beneficiaryBankCode '{}' is not a recognised bank code"
AMOUNT_ERROR = "amount {} is below the minimum for {}"
NO_RESULT_ERROR = "account validation service returned no results"
SOURCE_ACCOUNT_ERROR = "sourceAccount '{}' is invalid ({})"
BENEFICIARY_ACCOUNT_ERROR = "beneficiaryAccount '{}' is invalid ({})"

TYPE_REASON = "Transaction type '{}' is not configured."
BELOW_REASON = "Amount {} is below the minimum of {} for type '{}'."
ABOVE_REASON = "Amount {} exceeds the maximum of {} for type '{}'."
NOT_FOUND_REASON = "Account number '{}' not found for bank '{}'."
STATUS_REASON = "Account is {}."

STATUS_ACTIVE = "ACTIVE"
STATUS_NOT_FOUND = "NOT_FOUND"

# Texts searched for in the invalid output, one summary line each.
ERROR_TEXTS = (
    ("inactive", "INACTIVE"),
    ("not_found", "NOT_FOUND"),
    ("bank_code", "is not a recognised bank code"),
    ("below_minimum", "is below the minimum"),
    ("blocked", "BLOCKED"),
)

# --- limits of the request contract and of a run ----------------------------

MAX_BULK_ACCOUNTS = 100
DEFAULT_PARTITIONS = 10
JOB_NAME = "transactionValidationJob"
STOPPABLE_STATUSES = ("STARTED", "STARTING")
RESTARTABLE_STATUSES = ("STOPPED", "FAILED")

# --- seeded reference rows --------------------------------------------------

BANK_CODES = (
    ("BCA", "Bank Central Asia"),
    ("BNI", "Bank Negara Indonesia"),
    ("BRI", "Bank Rakyat Indonesia"),
    ("MANDIRI", "Bank Mandiri"),
    ("CIMB", "CIMB Niaga"),
    ("DANAMON", "Bank Danamon"),
    ("PERMATA", "Bank Permata"),
    ("BTN", "Bank Tabungan Negara"),
    ("BSI", "Bank Syariah Indonesia"),
    ("OCBC", "OCBC Indonesia"),
)

# transaction type, minimum, maximum (both inclusive), currency
TRANSACTION_LIMITS = (
    ("TRANSFER", "10000", "1000000000", "IDR"),
    ("PAYMENT", "1000", "500000000", "IDR"),
    ("TOPUP", "10000", "50000000", "IDR"),
    ("WITHDRAWAL", "50000", "20000000", "IDR"),
)

# account number, name, bank, status
ACCOUNTS = (
    ("1234567890", "Budi Santoso", "BCA", "ACTIVE"),
    ("0987654321", "Siti Rahayu", "BNI", "ACTIVE"),
    ("1122334455", "Ahmad Fauzi", "BRI", "ACTIVE"),
    ("5544332211", "Dewi Lestari", "MANDIRI", "ACTIVE"),
    ("6677889900", "Rudi Hermawan", "CIMB", "INACTIVE"),
    ("9900112233", "Rina Kusuma", "DANAMON", "ACTIVE"),
    ("3344556677", "Hendra Gunawan", "PERMATA", "BLOCKED"),
    ("7788990011", "Yuni Astuti", "BTN", "ACTIVE"),
    ("2233445566", "Fajar Nugroho", "BSI", "ACTIVE"),
    ("4455667788", "Indah Permata", "OCBC", "ACTIVE"),
    ("1357924680", "Wahyu Prasetyo", "BCA", "ACTIVE"),
    ("2468013579", "Maya Sari", "BRI", "ACTIVE"),
    ("1111222233", "Doni Kurniawan", "MANDIRI", "ACTIVE"),
    ("4444555566", "Lina Marlina", "BNI", "INACTIVE"),
    ("7777888899", "Agus Salim", "BSI", "ACTIVE"),
)

# --- generated input --------------------------------------------------------

GENERATOR_CURRENCY = "IDR"
UNKNOWN_BANK_CODES = ("XENDIT", "GOPAY", "OVO", "DANA", "FAKE_BANK")
UNKNOWN_NAME = "Unknown Person"
UNKNOWN_NUMBER_RANGE = (5_000_000_000, 9_999_999_999)
DEFAULT_INVALID_RATE = 0.15

NOTES = (
    "Monthly salary", "Invoice #4521", "Gift transfer", "Loan repayment",
    "School fees", "Business payment", "Online purchase", "Utility bill",
    "Insurance premium", "Subscription renewal", "", "", "",
)

# share of each fault among the invalid rows, in percent
FAULT_WEIGHTS = (
    ("bank_code", 30),
    ("inactive", 25),
    ("blocked", 15),
    ("unknown", 20),
    ("below_minimum", 10),
)

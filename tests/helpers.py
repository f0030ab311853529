"""Rows for the tests."""

from ledgersieve.fixed_values import TRANSACTION_FIELDS
from ledgersieve.operators.cleanse import cleanse
from ledgersieve.plans.validation import validate_transactions

HEADER = (
    "Reference ID,Source Account,Source Account Name,Source Bank Code,Beneficiary Account,"
    "Beneficiary Account Name,Beneficiary Bank Code,Currency,Amount,Transaction Type,Note"
)

# reference, source, bank, beneficiary, bank, amount, type, errors
GOLDEN = [
    ("TRX-T001", "1234567890", "BCA", "0987654321", "BNI", "500000", "TRANSFER", None),
    ("TRX-T002", "1122334455", "BRI", "5544332211", "MANDIRI", "250000", "TRANSFER", None),
    ("TRX-T003", "9900112233", "DANAMON", "7788990011", "BTN", "10000", "PAYMENT", None),
    ("TRX-T004", "2233445566", "BSI", "4455667788", "OCBC", "100000", "TOPUP", None),
    ("TRX-T005", "1357924680", "BCA", "1111222233", "MANDIRI", "750000", "TRANSFER", None),
    ("TRX-T006", "1234567890", "BCA", "6677889900", "CIMB", "200000", "TRANSFER",
     "beneficiaryAccount '6677889900' is invalid (INACTIVE)"),
    ("TRX-T007", "4444555566", "BNI", "0987654321", "BNI", "500000", "TRANSFER",
     "sourceAccount '4444555566' is invalid (INACTIVE)"),
    ("TRX-T008", "1234567890", "BCA", "3344556677", "PERMATA", "300000", "TRANSFER",
     "beneficiaryAccount '3344556677' is invalid (BLOCKED)"),
    ("TRX-T009", "1234567890", "XENDIT", "0987654321", "BNI", "500000", "TRANSFER",
     "sourceBankCode 'XENDIT' is not a recognised bank code; sourceAccount '1234567890' is invalid (NOT_FOUND)"),
    ("TRX-T010", "1234567890", "BCA", "0987654321", "GOPAY", "500000", "TRANSFER",
     "beneficiaryBankCode 'GOPAY' is not a recognised bank code; "
     "beneficiaryAccount '0987654321' is invalid (NOT_FOUND)"),
    ("TRX-T011", "1234567890", "BCA", "0987654321", "BNI", "5000", "TRANSFER",
     "amount 5000 is below the minimum for TRANSFER"),
    ("TRX-T012", "9999999999", "BRI", "1122334455", "BRI", "100000", "PAYMENT",
     "sourceAccount '9999999999' is invalid (NOT_FOUND)"),
    ("TRX-T013", "1357924680", "BCA", "8888888888", "MANDIRI", "50000", "PAYMENT",
     "beneficiaryAccount '8888888888' is invalid (NOT_FOUND)"),
]


def golden_line(row) -> str:
    ref, source, source_bank, beneficiary, beneficiary_bank, amount, kind, _ = row
    return f"{ref},{source},A,{source_bank},{beneficiary},B,{beneficiary_bank},IDR,{amount},{kind},note"


BASE = {
    "referenceId": "R", "sourceAccount": "1234567890", "sourceAccountName": "A", "sourceBankCode": "BCA",
    "beneficiaryAccount": "0987654321", "beneficiaryAccountName": "B", "beneficiaryBankCode": "BNI",
    "currency": "IDR", "amount": "500000", "transactionType": "TRANSFER", "note": "",
}


def raw_frame(spark, rows):
    """Raw transactions from changes to a valid row."""
    data = [tuple({**BASE, **row}[f] for f in TRANSACTION_FIELDS) for row in rows]
    return spark.createDataFrame(data, ", ".join(f"{f} string" for f in TRANSACTION_FIELDS))


def check(spark, references, rows):
    """The checked rows, in the order given."""
    numbered = [{**row, "referenceId": f"{i:05d}"} for i, row in enumerate(rows)]
    checked = validate_transactions(cleanse(raw_frame(spark, numbered)), references)
    return checked.orderBy("referenceId").collect()


def write_csv(path, lines, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(path)

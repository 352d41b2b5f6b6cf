"""The label domain, the rule tables and the other fixed values of the pipeline."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: label names and their order define the label ids -------------------

CATEGORY_LABELS = [
    "Housing", "Personal care", "Groceries", "Eating out", "Shopping", "Travel",
    "Transport", "Bills", "Transfers", "Cash", "Leisure", "Internal", "Income",
    "Charity", "Coffee", "Drinks", "Education", "Expenses", "Investments", "Lunch",
    "Gifts", "Kids", "Takeaway", "Petrol", "Rent", "Mortgage", "Utilities", "Vehicle",
    "Pets", "Savings",
]
TRANSACTION_LABELS = [
    "Salary", "Refund", "Energy", "Internet_mobile", "Video_streaming",
    "Music_streaming", "Gym", "Bonus_money",
]
EXCLUDED_LABELS = ["General"]

# --- Fixed values: sites whose accounts count for Dutch users ---------------------------

NL_SITE_IDS = [
    "b02fca30-65f6-470f-af1b-fbd5704abd56",
    "ed09586e-0f6d-44e3-8479-a5a35660f40b",
    "b17f3413-b84f-4495-8d5b-9ff1e840b7a6",
    "eedd41a8-51f8-4426-9348-314a18dbdec7",
    "c7987867-3219-4396-8d56-d79aff85a073",
    "1cc275ce-787f-45e1-bc0a-f8746cf5731b",
    "a6ccadc4-a2fa-11e9-a2a3-2a2ae2dbcce4",
    "6ed38773-34a6-4694-8e49-a50974f52510",
    "ee622d86-22cf-4f09-a475-198377971ff3",
    "2967f2c0-f0e6-4f1f-aeba-e4357b82ca7a",
    "bfdc30e3-1a08-4f2a-a85d-ac32c7227ccc",
    "2a609329-e2e8-44ac-9ee4-8896d68625ce",
    "7670247e-323e-4275-82f6-87f31119dbd3",
    "03433a5c-d1b1-41f7-b38f-119227bf7450",
    "44bbc1b2-029e-11e9-8eb2-f2801f1b9fd1",
    "13c00f7c-9746-11e9-bc42-526af7764f64",
]

# --- Fixed values: column names ---------------------------------------------------------

NUMERIC_INPUTS = ["amount", "transaction_type", "internal_transaction"]
MODEL_INPUTS = ["description", *NUMERIC_INPUTS]
HASHED_KEY = ["user_id_hashed", "account_id_hashed", "transaction_id_hashed", "date"]
PLAIN_KEY = ["user_id", "account_id", "transaction_id", "date"]

# --- Fixed values: model sizes and thresholds -------------------------------------------

SEQUENCE_LENGTH = 60
VOCABULARY_SIZE = 600_000
EMBEDDING_SIZE = 32
TRIPLET_MARGIN = 0.1
SIMILARITY_THRESHOLD = 0.55
MAX_RECALL_RANK = 3
MIN_PRECISION = MIN_RECALL = MIN_F1 = 0.60
SUPPRESSED = -1.0
TEST_DESCRIPTION_PREFIX = "test_description:5cb92fb6-93c5-452f-aa27-53a485b8f370:"
TEST_LABEL_PATTERN = "([A-Z][a-z_]+)"
NOISE_PATTERN = r"[^a-zA-Z\d]+|\d{2,}"

# --- Fixed values: which labels can never stand together, and the evaluation groups -----

CONFLICTING_PAIRS = [
    ("Salary", "Refund"), ("Salary", "Energy"), ("Salary", "Internet_mobile"),
    ("Salary", "Video_streaming"), ("Salary", "Music_streaming"), ("Salary", "Gym"),
    ("Salary", "Bonus_money"),
]
COUNTRIES = ["GB", "FR", "IT", "NL"]
COUNTRY_GROUPS = {**{country: [country] for country in COUNTRIES}, "ALL": COUNTRIES}

# --- Derived ------------------------------------------------------------------------------

TRAINING_LABELS = CATEGORY_LABELS + TRANSACTION_LABELS
# The excluded label comes last so that every trainable label has an id below it.
LABELS = TRAINING_LABELS + EXCLUDED_LABELS
GENERAL = EXCLUDED_LABELS[0]


@dataclass(frozen=True)
class SimilarityRule:
    """Overwrite a label's similarity when a numeric feature has the given value."""

    label: str
    feature: str
    value: float = 1.0
    similarity: float = SUPPRESSED


@dataclass(frozen=True)
class TaxRule:
    """Add a tax label when every pattern finds a match in its column."""

    country_code: str
    label: str
    patterns: tuple[tuple[str, str], ...]


# --- Fixed values: which labels a numeric feature rules out -----------------------------------

# Money a person pays is neither salary, refund nor bonus; moving money between own accounts
# is none of these labels except salary.
SIMILARITY_RULES = [
    SimilarityRule("Salary", "is_debit_transaction"),
    SimilarityRule("Refund", "is_debit_transaction"),
    SimilarityRule("Bonus_money", "is_debit_transaction"),
    SimilarityRule("Refund", "is_internal_transaction"),
    SimilarityRule("Energy", "is_internal_transaction"),
    SimilarityRule("Internet_mobile", "is_internal_transaction"),
    SimilarityRule("Video_streaming", "is_internal_transaction"),
    SimilarityRule("Music_streaming", "is_internal_transaction"),
    SimilarityRule("Gym", "is_internal_transaction"),
    SimilarityRule("Bonus_money", "is_internal_transaction"),
]

# Only the rules that the known examples show; callers bring their own table for more.
TAX_RULES = [
    TaxRule("NL", "venootschapsbelasting", (
        ("bank_counterparty_iban", r"^NL86INGB0002445588$"), ("description", r"(?i)\bvpb\b"),
    )),
    TaxRule("NL", "motorrijtuigenbelasting", (
        ("bank_counterparty_iban", r"^NL86INGB0002445588$"),
        ("description", r"\b(?:[A-Z]{2}-\d{3}-[A-Z]|[A-Z]-\d{3}-[A-Z]{2}|\d{2}-[A-Z]{2}-[A-Z]{2})\b"),
    )),
    TaxRule("GB", "corporate_tax", (("description", r"(?i)hmrc corporation t"),)),
    TaxRule("GB", "vehicle_tax", (("description", r"(?i)dvla vehicle"),)),
]

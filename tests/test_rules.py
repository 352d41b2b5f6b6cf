import random

from pyspark.sql import functions as F

from ledgertag.domain import (
    SIMILARITY_RULES,
    SIMILARITY_THRESHOLD,
    TEST_DESCRIPTION_PREFIX,
    TRAINING_LABELS,
    TRANSACTION_LABELS,
    TaxRule,
)
from ledgertag.operators.rules import (
    add_tax_labels,
    apply_similarity_rules,
    apply_test_descriptions,
    eliminate_conflicts,
    indicators,
    label_set,
    tax_label,
)

SCORED = "is_debit_transaction double, is_internal_transaction double, similarities array<double>"


def test_ten_rules():
    assert len(SIMILARITY_RULES) == 10
    assert {r.feature for r in SIMILARITY_RULES if r.label == "Salary"} == {"is_debit_transaction"}


def test_rules_matrix(spark):
    """Six rows with strong similarities; only rows 2 and 3 may keep a label, and it is Salary."""
    random.seed(7)
    strong = [
        {"Salary": 1.0}, {"Refund": 1.0}, {"Refund": 0.7, "Salary": 1.0}, {"Salary": 1.0},
        {"Bonus_money": 1.0}, {"Bonus_money": 1.0},
    ]
    debit, internal = [1.0, 1.0, 0.0, 0.0, 0.0, 1.0], [0.0, 0.0, 0.0, 1.0, 1.0, 0.0]
    data = []
    for i, given in enumerate(strong):
        row = [random.uniform(0, SIMILARITY_THRESHOLD - 1e-9) for _ in TRAINING_LABELS]
        for label, value in given.items():
            row[TRAINING_LABELS.index(label)] = value
        data.append((debit[i], internal[i], row))
    scored = eliminate_conflicts(apply_similarity_rules(spark.createDataFrame(data, SCORED)))
    flags = [r[0] for r in scored.select(indicators(F.col("similarities"))).collect()]
    salary = [1] + [0] * 7
    assert flags == [[0] * 8, [0] * 8, salary, salary, [0] * 8, [0] * 8]
    assert scored.columns == ["is_debit_transaction", "is_internal_transaction", "similarities"]


def one_by_one(values, labels, pairs):
    values = list(values)
    for pair in pairs:
        at = [labels.index(label) for label in pair]
        best = max(values[i] for i in at)
        for i in at:
            if values[i] != best:
                values[i] = -1.0
    return values


def test_conflicts_equal_the_pairs_taken_in_turn(spark):
    random.seed(3)
    pairs = [("Salary", other) for other in TRANSACTION_LABELS[1:]]
    data = [
        ([random.choice([-1.0, 0.0, 0.2, 0.4, 0.6]) for _ in TRANSACTION_LABELS],) for _ in range(500)
    ]
    df = spark.createDataFrame(data, "similarities array<double>")
    found = [r[0] for r in eliminate_conflicts(df, TRANSACTION_LABELS, pairs).collect()]
    assert found == [one_by_one(row, TRANSACTION_LABELS, pairs) for (row,) in data]


def test_undefined_similarities_give_no_label(spark):
    df = spark.createDataFrame([(0.0, 0.0, None)], SCORED)
    scored = eliminate_conflicts(apply_similarity_rules(df))
    flags = scored.select(indicators(F.col("similarities")).alias("f"))
    assert flags.select(label_set(F.col("f"))).first()[0] == []


NL_IBAN = "NL86INGB0002445588"
PLATE = (
    "Naam: BELASTINGDIENST\nOmschrijving: VJ-104-X 01-10-2020\nt/m 30-10-2020 MEER INFO\n"
    "WWW.BELASTINGDIENST.NL\nIBAN: NL86INGB0002445588\nKenmerk: COAXX579982000202010211301038114647"
)
REFUND = "TERUGGAAF NR. 851494523V760112 VPB.2017 (JACHTTRUST )"
TAX_CASES = [
    ("hmrc corporation t 4106400364a00102a BBP", "GB", None, {"Tax_gb_corporate_tax"}),
    ("hmrc corporation t 4106400364a00102a BBP", None, None, {"Tax_gb_corporate_tax"}),
    ("dvla vehicle", "GB", None, {"Tax_gb_vehicle_tax"}),
    ("purple cats ate cute!", "DE", None, set()),
    ("teruggaaf", "NL", "NL58INGB0649306597", set()),
    (REFUND, None, NL_IBAN, {"Tax_nl_venootschapsbelasting"}),
    (REFUND, "GB", NL_IBAN, set()),
    (PLATE, None, NL_IBAN, {"Tax_nl_motorrijtuigenbelasting"}),
    ("dvla vehicle " + PLATE, None, NL_IBAN, {"Tax_nl_motorrijtuigenbelasting", "Tax_gb_vehicle_tax"}),
    ("Refund", None, None, set()),
]


def test_tax_cases(spark):
    df = spark.createDataFrame(
        [(text, country, iban, []) for text, country, iban, _ in TAX_CASES],
        "description string, country_code string, bank_counterparty_iban string, labels array<string>",
    )
    assert [set(r.labels) for r in add_tax_labels(df).collect()] == [c[3] for c in TAX_CASES]
    bare = add_tax_labels(df.select("description", "labels"))
    assert set(bare.first().labels) == {"Tax_gb_corporate_tax"}


def test_first_fitting_rule_counts(spark):
    rules = [TaxRule("GB", "one", (("t", "a.c"),)), TaxRule("GB", "two", (("t", "abc"),))]
    df = spark.createDataFrame([("abc",), ("xabcx",), ("b",), (None,)], "t string")
    assert [r[0] for r in df.select(tax_label("GB", rules, df.columns)).collect()] == ["one", "one", None, None]


def test_test_descriptions_replace_labels(spark):
    df = spark.createDataFrame(
        [(TEST_DESCRIPTION_PREFIX + "Test_music_streaming, Test_gym", ["x"]),
         ("Sales_tax, Other_income", []), (TEST_DESCRIPTION_PREFIX, ["x"]), (None, ["x"])],
        "description string, labels array<string>",
    )
    found = [set(r.labels) for r in apply_test_descriptions(df).collect()]
    assert found == [{"Test_music_streaming", "Test_gym"}, set(), set(), {"x"}]


def test_untouched_similarities_are_copied_in_runs(spark):
    """Named one by one they make generated code too long to be compiled well."""
    values = [i / 100 for i in range(len(TRAINING_LABELS))]
    df = spark.createDataFrame(
        [(values, 1.0, 0.0), (None, 1.0, 0.0)],
        "similarities array<double>, is_debit_transaction double, is_internal_transaction double",
    )
    found = eliminate_conflicts(apply_similarity_rules(df))
    text = found._jdf.queryExecution().analyzed().toString()
    assert text.count("slice(similarities") == 2
    rows = found.collect()
    ruled = [-1.0 if label in ("Salary", "Refund", "Bonus_money") else v for label, v in zip(TRAINING_LABELS, values)]
    assert rows[0]["similarities"] == ruled and rows[1]["similarities"] is None

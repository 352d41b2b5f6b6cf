"""From similarities to label sets: override rules, conflicts, threshold, tax and test labels.

All rule tables are small and fixed before the job starts; they become column expressions, so
every step works on its row alone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertag.domain import (
    CONFLICTING_PAIRS,
    SIMILARITY_RULES,
    SIMILARITY_THRESHOLD,
    SUPPRESSED,
    TAX_RULES,
    TEST_DESCRIPTION_PREFIX,
    TRAINING_LABELS,
    TRANSACTION_LABELS,
    SimilarityRule,
    TaxRule,
)
from ledgertag.functions.text import labels_in_text


def _with_entries(column: str, changed: dict[int, Column], size: int) -> Column:
    """An array of ``size`` entries with some of them changed; a null array stays null.

    The others are copied in runs: named one by one, they make code that is too long to be compiled well.
    """
    parts, i = [], 0
    while i < size:
        j = i
        while j < size and (j in changed) == (i in changed):
            j += 1
        parts.append(F.array(*[changed[k] for k in range(i, j)]) if i in changed else F.slice(column, i + 1, j - i))
        i = j
    return F.when(F.col(column).isNotNull(), F.concat(*parts))


def apply_similarity_rules(
    df: DataFrame,
    labels: list[str] = TRAINING_LABELS,
    rules: list[SimilarityRule] = SIMILARITY_RULES,
    column: str = "similarities",
) -> DataFrame:
    """Overwrite similarities where a rule fires; of several rules the last one wins."""
    changed: dict[int, Column] = {}
    for rule in rules:
        for i in (i for i, label in enumerate(labels) if label == rule.label):
            fires = F.col(rule.feature) == rule.value
            value = changed.get(i, F.col(column)[i])
            changed[i] = F.when(fires, F.lit(rule.similarity)).otherwise(value)
    return df.withColumn(column, _with_entries(column, changed, len(labels)))


def eliminate_conflicts(
    df: DataFrame,
    labels: list[str] = TRAINING_LABELS,
    pairs: list[tuple[str, str]] = CONFLICTING_PAIRS,
    column: str = "similarities",
) -> DataFrame:
    """In each pair, one after the other, suppress the lower label; equal ones both stay.

    A label suppressed early is already suppressed in later pairs.
    """
    involved = [label for label in labels if any(label in pair for pair in pairs)]
    kept = df.columns
    temporary = {label: f"_similarity_{labels.index(label)}" for label in involved}
    step = df.withColumns(
        {name: F.col(column)[labels.index(label)] for label, name in temporary.items()}
    )
    for one, other in pairs:
        a, b = F.col(temporary[one]), F.col(temporary[other])
        step = step.withColumns({
            temporary[one]: F.when(a < b, F.lit(SUPPRESSED)).otherwise(a),
            temporary[other]: F.when(b < a, F.lit(SUPPRESSED)).otherwise(b),
        })
    changed = {i: F.col(temporary[label]) for i, label in enumerate(labels) if label in temporary}
    return step.withColumn(column, _with_entries(column, changed, len(labels))).select(*kept)


def indicators(
    similarities: Column,
    labels: list[str] = TRAINING_LABELS,
    wanted: list[str] = TRANSACTION_LABELS,
    threshold: float = SIMILARITY_THRESHOLD,
) -> Column:
    """1 where the similarity of a wanted label reaches the threshold, else 0."""
    return F.array(*[
        F.coalesce((similarities[labels.index(label)] >= threshold).cast("int"), F.lit(0))
        for label in wanted
    ])


def label_set(flags: Column, labels: list[str] = TRANSACTION_LABELS) -> Column:
    """The names of the labels whose flag is set."""
    return F.array_compact(
        F.array(*[F.when(flags[i] == 1, F.lit(label)) for i, label in enumerate(labels)])
    )


def add_label(labels: Column, prefix: str, label: Column) -> Column:
    """Add prefix and lower-case label to a set; a missing label adds nothing."""
    added = F.array_compact(F.array(F.concat(F.lit(f"{prefix}_"), F.lower(label))))
    return F.array_union(labels, added)


def matches(text: Column, pattern: str) -> Column:
    """Search for a pattern; one without special characters needs no pattern matching."""
    literal = pattern.removeprefix("(?i)")
    if re.fullmatch(r"[A-Za-z0-9 _-]+", literal) is None:
        return text.rlike(pattern)
    return text.contains(literal) if literal == pattern else F.lower(text).contains(literal.lower())


def tax_label(country: str, rules: list[TaxRule], columns: list[str]) -> Column:
    """The label of the first rule of the country that fits."""
    label = F.lit(None).cast("string")
    for rule in reversed([r for r in rules if r.country_code == country]):
        fits = F.lit(True)
        for column, pattern in rule.patterns:
            text = F.coalesce(F.col(column), F.lit("")) if column in columns else F.lit("")
            fits &= matches(text, pattern)
        label = F.when(fits, F.lit(rule.label)).otherwise(label)
    return label


def add_tax_labels(df: DataFrame, rules: list[TaxRule] = TAX_RULES) -> DataFrame:
    """Add the tax label of the row's country; without a country, those of all countries.

    The label of each country is a column of its own first, so that every pattern is tried
    once per row.
    """
    country = F.col("country_code") if "country_code" in df.columns else F.lit(None)
    codes = list(dict.fromkeys(rule.country_code for rule in rules))
    known = df.withColumn("country_code", F.coalesce(country.cast("string"), F.lit("")))
    found = known.withColumns({
        f"_tax_{code}": F.when(
            F.col("country_code").isin(code, ""), tax_label(code, rules, df.columns)
        )
        for code in codes
    })
    labels = F.col("labels")
    for code in codes:
        labels = add_label(labels, f"Tax_{code.lower()}", F.col(f"_tax_{code}"))
    return found.withColumn("labels", labels).drop(*[f"_tax_{code}" for code in codes])


def apply_test_descriptions(
    df: DataFrame, prefix: str = TEST_DESCRIPTION_PREFIX
) -> DataFrame:
    """Where the description starts with the prefix, its capitalised words are the labels."""
    text = F.coalesce(F.col("description"), F.lit(""))
    wanted = F.when(text.startswith(prefix), labels_in_text(text)).otherwise(F.col("labels"))
    return df.withColumn("labels", wanted)


def apply_label_rules(
    df: DataFrame,
    rules: list[TaxRule] = TAX_RULES,
    prefix: str = TEST_DESCRIPTION_PREFIX,
) -> DataFrame:
    """Tax labels, then test descriptions."""
    return apply_test_descriptions(add_tax_labels(df, rules), prefix)

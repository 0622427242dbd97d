"""Checks of a classifier's answers against their contract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportarium.functions.text import keyword_matches, word_count
from reportarium.schemas import ANSWER

# What an answer may contain.
ENTITIES = (
    "Customer",
    "Client",
    "Policyholder",
    "Buyer",
    "Broker",
    "Policy",
    "Claim",
    "Invoice",
    "Contract",
    "Credit Limit",
    "Recovery Case",
    "Business Unit",
    "Product",
    "Cost Centre",
    "Declaration",
    "Premium",
    "Country",
    "Reinsurance",
    "Portfolio",
)
PURPOSES = ("Management", "Operational", "Regulatory", "Analytical", "Ad-hoc", "Unknown")
GEO_SCOPES = ("Domestic", "Cross-Border", "Unknown")
SUBJECTS = ("Client / Policyholder", "Buyer", "Both", "Not Entity-Specific", "Unknown")
CONFIDENCES = ("low", "medium", "high", "very-high")
DOMAINS = (
    "Strategy and Compliance Management",
    "Market Management",
    "Corporate Relations and Services",
    "Distribution & Channel Management",
    "Customer Relationship Management",
    "Contract Management",
    "Buyer Underwriting",
    "Claims and Recovery Management",
    "Collections Management",
    "Financial Compliance Management",
    "HR Management",
    "IT Management",
    "Facility Management",
    "Procurement Management",
    "Product Management",
    "Change Management",
    "Process Management",
    "Document Management",
    "Output Management",
    "Data Management",
    "Unknown",
)
ALLOWED = {
    "report_purpose": PURPOSES,
    "geo_scope": GEO_SCOPES,
    "entity_subject": SUBJECTS,
    "confidence": CONFIDENCES,
    "monitored_entities": ENTITIES,
}
ALLOWED_DOMAIN = {"business_domain": DOMAINS, "confidence": CONFIDENCES}
# Words a description may have, and the most other texts may have.
DESCRIPTION_WORDS = (15, 50)
SHORT_TEXT_WORDS = 20
SHORT_TEXTS = ("report_purpose_description", "geo_scope_description", "entity_subject_description")
# Technical terms a description must not use.
FORBIDDEN = ("universe", "universes", "database", "databases", "SQL", "ETL", "Power BI", "Databricks")


def parse_answers(df: DataFrame, answer: str, schema: T.StructType = ANSWER) -> DataFrame:
    """Add ``is_json`` and the fields of the answer text; text that is no object has null fields."""
    shape = F.schema_of_variant(F.try_parse_json(F.col(answer)))
    parsed = df.withColumn("is_json", F.coalesce(shape.startswith("OBJECT"), F.lit(False)))
    fields = F.when(F.col("is_json"), F.from_json(answer, schema))
    return parsed.withColumn("__answer", fields).select(*df.columns, "is_json", "__answer.*")


def _names(flags: Mapping[str, Column]) -> Column:
    """Sorted names whose flag is true."""
    named = F.array(*(F.when(flags[n], F.lit(n)) for n in sorted(flags)))
    return F.array_compact(named)


def missing_fields(schema: T.StructType = ANSWER) -> Column:
    return _names({f.name: F.col(f.name).isNull() for f in schema})


def bad_values(
    schema: T.StructType = ANSWER, allowed: Mapping[str, Sequence[str]] = ALLOWED
) -> Column:
    """Fields holding a value outside their list; a missing field is not counted here."""
    flags = {}
    for name, values in allowed.items():
        column = F.col(name)
        if isinstance(schema[name].dataType, T.ArrayType):
            listed = F.array(*(F.lit(v) for v in values))
            flags[name] = F.size(F.array_except(column, listed)) > 0
        else:
            flags[name] = ~column.isin(*values)
    return _names(flags)


def sentence_count(text: Column) -> Column:
    """Sentences of a text; one ends at marks that are followed by white space and more."""
    breaks = F.regexp_count(text, F.lit(r"[.!?]\s+\S"))
    return F.when(text.rlike(r"[^\s.!?]"), breaks + 1).when(text.isNotNull(), 0)


def bad_lengths() -> Column:
    """Texts too short or too long, and a description that is not one sentence."""
    low, high = DESCRIPTION_WORDS
    description = F.col("report_description")
    flags = {
        "report_description": ~word_count(description).between(low, high),
        "report_description_sentences": sentence_count(description) != 1,
    }
    for name in SHORT_TEXTS:
        flags[name] = word_count(F.col(name)) > SHORT_TEXT_WORDS
    return _names(flags)


def forbidden_terms(text: Column, terms: Sequence[str] = FORBIDDEN) -> Column:
    """Terms of the list that occur in the text as whole words, whatever their case."""
    found = F.array_distinct(keyword_matches(F.coalesce(text, F.lit("")), terms))
    listed = {t.lower(): t for t in terms}
    if all(k == t for k, t in listed.items()):
        return F.sort_array(found)
    written = F.create_map(*(F.lit(x) for pair in listed.items() for x in pair))
    return F.sort_array(F.transform(found, lambda k: written[k]))


def check_answers(
    df: DataFrame, answer: str, terms: Sequence[str] = FORBIDDEN
) -> DataFrame:
    """Parsed answers with the findings of all checks and ``accepted``."""
    checked = (
        parse_answers(df, answer)
        .withColumn("missing", missing_fields())
        .withColumn("bad_values", bad_values())
        .withColumn("bad_lengths", bad_lengths())
        .withColumn("forbidden", forbidden_terms(F.col("report_description"), terms))
    )
    clean = [F.size(c) == 0 for c in ("missing", "bad_values", "bad_lengths", "forbidden")]
    accepted = F.col("is_json")
    for finding in clean:
        accepted = accepted & finding
    return checked.withColumn("accepted", accepted)


def check_domain_answers(df: DataFrame, answer: str, schema: T.StructType) -> DataFrame:
    """The same for the domain contract, which has neither lengths nor terms."""
    checked = (
        parse_answers(df, answer, schema)
        .withColumn("missing", missing_fields(schema))
        .withColumn("bad_values", bad_values(schema, ALLOWED_DOMAIN))
    )
    return checked.withColumn(
        "accepted", F.col("is_json") & (F.size("missing") == 0) & (F.size("bad_values") == 0)
    )


def weakest(*confidences: Column) -> Column:
    """The lowest of several confidence levels; unknown levels do not count."""
    ranks = F.array(*(F.lit(c) for c in CONFIDENCES))
    places = F.array(*(F.nullif(F.array_position(ranks, c), F.lit(0)) for c in confidences))
    return F.get(ranks, (F.array_min(places) - 1).cast("int"))

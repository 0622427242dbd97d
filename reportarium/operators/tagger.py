"""Keyword tagger: a deterministic baseline for the domain question.

The estate sends this question to a model; counting keywords is our own stand-in, so
that answers can be compared with something that needs no outside service.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportarium.functions.text import keyword_matches

# Words that guide towards a business domain.
KEYWORDS = {
    "Financial Compliance Management": (
        "accounting", "ledger", "finance", "journals", "financial reporting", "treasury",
        "provisioning", "audits", "compliance",
    ),
    "Customer Relationship Management": (
        "customer portfolios", "customer activity", "customer onboarding",
        "customer interactions", "sales funnels",
    ),
    "Contract Management": ("policies", "contracts", "invoices", "policy issuance", "renewals"),
    "Buyer Underwriting": ("buyers", "credit limits", "buyer risk", "underwriting"),
    "Claims and Recovery Management": (
        "claims", "recoveries", "disputes", "collections after claim events",
    ),
    "Collections Management": (
        "debt collection operations", "collection registration", "collection activities",
    ),
    "Distribution & Channel Management": (
        "brokers", "agencies", "partners", "channels", "portals", "touchpoints",
    ),
    "Market Management": ("market analysis", "segmentation", "campaigns"),
    "Corporate Relations and Services": ("legal matters", "communications"),
    "Product Management": ("products", "product analysis", "product development"),
    "IT Management": ("applications", "systems", "it operations", "infrastructure"),
    "Document Management": ("documents", "archives", "document workflows"),
    "Data Management": ("data quality", "master data", "metadata", "data governance"),
}
# Evidence sources, strongest first.
EVIDENCE = (
    "report_title",
    "report_description",
    "folder_path",
    "variables",
    "additional_metadata",
    "owner",
    "consumers",
)
NONE = "Unknown"


def _best(matches: Column, keywords: Mapping[str, Sequence[str]], source: str) -> Column:
    """Domain with most matches, null without any."""
    ranked = [
        F.struct(
            F.size(F.filter(matches, lambda m: m.isin(*(w.lower() for w in words)))).alias("hits"),  # noqa: B023
            F.lit(-place).alias("place"),
            F.lit(domain).alias("domain"),
            F.lit(source).alias("source"),
        )
        for place, (domain, words) in enumerate(keywords.items())
    ]
    return F.when(F.size(matches) > 0, F.array_max(F.array(*ranked)))


def tag_domain(
    df: DataFrame,
    sources: Sequence[str] = EVIDENCE,
    keywords: Mapping[str, Sequence[str]] = KEYWORDS,
) -> DataFrame:
    """Add ``business_domain``, ``evidence_source``, ``hits``.

    The strongest source with any keyword decides, there the domain with most hits,
    there the first in the order of ``keywords``. Words and runs of words are looked up
    within their own row: no exploded words, no join, no shuffle.
    """
    kept = df.columns
    words = [w for listed in keywords.values() for w in listed]
    matches = {f"__m{i}": keyword_matches(F.col(s), words) for i, s in enumerate(sources)}
    found = [_best(F.col(f"__m{i}"), keywords, s) for i, s in enumerate(sources)]
    best = df.select(*kept, *(m.alias(name) for name, m in matches.items())).select(
        *kept, F.coalesce(*found).alias("__best")
    )
    return best.select(
        *kept,
        F.coalesce("__best.domain", F.lit(NONE)).alias("business_domain"),
        F.col("__best.source").alias("evidence_source"),
        F.coalesce("__best.hits", F.lit(0)).alias("hits"),
    )

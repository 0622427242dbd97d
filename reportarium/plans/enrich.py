"""Documents put together for an outside classifier, and the requests sent to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportarium.operators import contract

# Settings of a request.
MAX_TOKENS = 1500
TEMPERATURE = 0


def enriched_documents(profile: DataFrame, fields: DataFrame, samples: DataFrame) -> DataFrame:
    """Profiles of the documents that have both a field dictionary and an output sample."""
    nested = fields.select(
        "document_id", F.struct("variables_count", "variables").alias("fields")
    )
    return profile.join(samples, "document_id").join(nested, "document_id")


def instructions() -> str:
    """System message: the contract of the answer, out of the lists the checks use."""
    low, high = contract.DESCRIPTION_WORDS
    lists = "\n".join(f"{name}: {', '.join(values)}" for name, values in contract.ALLOWED.items())
    return (
        "Classify one report from its metadata only. Answer with a single JSON object having "
        f"the fields {', '.join(f.name for f in contract.ANSWER)}.\n"
        f"Take values from these lists.\n{lists}\n"
        f"report_description is one sentence of {low} to {high} words without technical terms; "
        f"other descriptions have at most {contract.SHORT_TEXT_WORDS} words. "
        "confidence is that of the weakest part."
    )


def request_json(
    content: Column,
    system: str | None = None,
    max_tokens: int = MAX_TOKENS,
    temperature: int = TEMPERATURE,
) -> Column:
    """Request body: a system and a user message and the settings."""
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.to_json(
        F.struct(
            F.array(
                message("system", F.lit(instructions() if system is None else system)),
                message("user", content),
            ).alias("messages"),
            F.lit(max_tokens).alias("max_tokens"),
            F.lit(temperature).alias("temperature"),
        )
    )


def document_requests(enriched: DataFrame) -> DataFrame:
    """One request per document: ``document_id, request``."""
    content = F.to_json(F.struct(*enriched.columns))
    return enriched.select("document_id", request_json(content).alias("request"))

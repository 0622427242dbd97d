"""Tokens and cost of model calls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportarium.schemas import USAGE_ANSWER

# Price units per million tokens.
INPUT_PER_MILLION = 1.0
OUTPUT_PER_MILLION = 4.286


def token_audit(responses: DataFrame, body: str = "body") -> DataFrame:
    """Usage numbers nested in the responses: ``model, tokens_in, tokens_out, prompt_id``."""
    return responses.select(F.from_json(body, USAGE_ANSWER).alias("r")).select(
        F.col("r.model").alias("model"),
        F.col("r.usage.prompt_tokens").alias("tokens_in"),
        F.col("r.usage.completion_tokens").alias("tokens_out"),
        F.col("r.id").alias("prompt_id"),
    )


def token_cost(
    audit: DataFrame,
    input_rate: float = INPUT_PER_MILLION,
    output_rate: float = OUTPUT_PER_MILLION,
) -> DataFrame:
    """Calls, tokens and cost per model."""
    million = 1_000_000
    return (
        audit.groupBy("model")
        .agg(
            F.count("*").alias("calls"),
            F.sum("tokens_in").alias("tokens_in"),
            F.sum("tokens_out").alias("tokens_out"),
        )
        .withColumn(
            "cost",
            F.round(
                F.col("tokens_in") / million * input_rate
                + F.col("tokens_out") / million * output_rate,
                6,
            ),
        )
    )

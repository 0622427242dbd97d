"""Field dictionary: what a report's variables are and where they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportarium.operators.lists import distinct_records, record_lists

# The parts of a field definition.
DEFINITION = (
    "entry_type",
    "entry_name",
    "entry_datatype",
    "entry_qualification",
    "extracted_datafield",
    "universe_name",
    "datafield_datasourcepath",
    "datafield_description",
    "sql_definition",
    "variable_definition",
    "datafield_name_universe",
)


def field_entries(entries: DataFrame, scope: DataFrame) -> DataFrame:
    """Distinct field definitions of the documents in scope, a row each.

    Ids are compared as trimmed text.
    """
    ids = scope.select(F.col("document_id").cast("string").alias("document_id"))
    return distinct_records(_trimmed(entries), ["document_id"], DEFINITION, only=ids)


def field_dictionary(entries: DataFrame, scope: DataFrame) -> DataFrame:
    """``document_id, variables_count, variables``: one row per document in scope."""
    ids = scope.select(F.col("document_id").cast("string").alias("document_id"))
    found = record_lists(_trimmed(entries), ["document_id"], DEFINITION, "variables", only=ids)
    return found.select("document_id", "variables_count", "variables")


def _trimmed(entries: DataFrame) -> DataFrame:
    return entries.withColumn("document_id", F.trim(F.col("document_id").cast("string")))


def definition_json(variables: str = "variables") -> Column:
    """The definitions as JSON texts; parts that are null are left out of each."""
    return F.transform(variables, lambda v: F.to_json(v))

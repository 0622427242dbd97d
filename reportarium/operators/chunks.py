"""Long text cut into numbered pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: characters per piece of an exported statement.
CHUNK_CHARS = 32_000


def chunk_text(
    df: DataFrame, text: str, index: str, size: int = CHUNK_CHARS, partial: str = "is_partial"
) -> DataFrame:
    """One row per piece of ``text``; ``index`` becomes ``i_k`` and ``partial`` true for cut texts.

    One pass over the text (a repeated ``substring`` would start from the front for
    every piece). A null or empty text stays one row.
    """
    pieces = F.when(
        F.char_length(text) > size,
        F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{size}}}"), F.lit(0)),
    ).otherwise(F.array(F.col(text)))
    cut = F.size("__pieces") > 1
    numbered = F.concat(F.col(index).cast("string"), F.lit("_"), F.col("__no").cast("string"))
    kept = [c for c in df.columns if c not in (text, index)]
    return (
        df.withColumn("__pieces", pieces)
        .select(*kept, F.col(index), "__pieces", F.posexplode_outer("__pieces").alias("__no", text))
        .select(
            *kept,
            F.when(cut, numbered).otherwise(F.col(index).cast("string")).alias(index),
            cut.alias(partial),
            F.col("__no").alias("chunk_no"),
            text,
        )
    )

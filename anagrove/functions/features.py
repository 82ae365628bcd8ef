"""Column expressions on frequencies, embeddings and frequency bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_frequency(frequency: Column) -> Column:
    return F.log10(frequency.cast("double") + 1.0)


def concat_features(log_freq: Column, embedding: Column) -> Column:
    """Log frequency in front of the embedding, as one array."""
    return F.concat(F.array(log_freq.cast("double")), embedding.cast("array<double>"))


def band(log_freq: Column, low_mid: Column, mid_high: Column) -> Column:
    """Frequency band of a row; both edges belong to the outer bands.

    ``high`` is tested first so that it wins when the edges cross. A missing or
    NaN frequency belongs to no band and stops the job.
    """
    usable = log_freq.isNotNull() & ~F.isnan(log_freq)
    routed = F.when(log_freq >= mid_high, "high").when(log_freq <= low_mid, "low").otherwise("mid")
    return F.when(usable, routed).otherwise(
        F.raise_error(F.lit("a row without a frequency belongs to no band")).cast("string")
    )


def embedding_is_valid(embedding: Column, expected_length: int) -> Column:
    """Right length and no missing or NaN element; never null itself."""
    broken = F.exists(embedding, lambda x: x.isNull() | F.isnan(x))
    return F.coalesce((F.size(embedding) == expected_length) & ~broken, F.lit(False))

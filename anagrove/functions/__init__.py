from anagrove.functions.features import (
    band,
    concat_features,
    embedding_is_valid,
    log_frequency,
)
from anagrove.functions.letters import (
    eligible,
    letter_set,
    subset_keys,
    tokens,
    unquote_line,
)

__all__ = [
    "band",
    "concat_features",
    "eligible",
    "embedding_is_valid",
    "letter_set",
    "log_frequency",
    "subset_keys",
    "tokens",
    "unquote_line",
]

"""All queries of this subpackage."""

from llm import (  # noqa: F401
    alignment, bpe, decontamination, html_text, language_id, line_dedup, near_dedup, pii, quality, resampling, syncmers,
    token_files, toxicity,
)
from llm.registry import all_queries, all_sql  # noqa: F401

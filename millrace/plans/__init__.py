"""All registered queries."""

from millrace.plans import (  # noqa: F401
    entity, language, models, relational, sequences, weblog, words,
)
from millrace.plans.registry import all_queries, all_sql  # noqa: F401

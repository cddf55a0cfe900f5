"""All named queries."""

from millrace.queries import batch, clinical, events, models, preprocessing  # noqa: F401
from millrace.queries.registry import QUERIES, SQL  # noqa: F401

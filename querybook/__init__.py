"""The registered queries: every operator bound to the given tables.

Each module adds (query, SQL text of the same result) pairs to ``registry``.
"""

from querybook import (  # noqa: F401
    boosting,
    cleaning,
    evaluation,
    features,
    loans,
    models,
    monitoring,
    stores,
)
from querybook.registry import ORACLES, QUERIES  # noqa: F401

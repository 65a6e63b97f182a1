"""All queries of the core."""

from corpuspark.plans import audit, cards, collection, extras, frequency, library, texts  # noqa: F401
from corpuspark.plans.registry import QUERIES, SQL  # noqa: F401

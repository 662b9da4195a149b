"""planmatch: product-to-planning-category matching and sales/inventory
summaries as Spark DataFrame plans."""

from planmatch.config import (  # noqa: F401
    FIXTURE_INVENTORY,
    FIXTURE_SALES,
    FIXTURE_WHOLESALE,
    INVENTORY,
    SALES,
    WHOLESALE,
    RuleSet,
    WholesaleRules,
)

__all__ = [
    "RuleSet", "WholesaleRules", "SALES", "INVENTORY", "WHOLESALE",
    "FIXTURE_SALES", "FIXTURE_INVENTORY", "FIXTURE_WHOLESALE",
]

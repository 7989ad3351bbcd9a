"""All registered queries."""

from . import (  # noqa: F401
    catalog_curves, catalog_fitted, catalog_learning, catalog_metrics, catalog_models, catalog_panel,
    catalog_prep, catalog_scenario)
from .registry import CATALOG

__all__ = ["CATALOG"]

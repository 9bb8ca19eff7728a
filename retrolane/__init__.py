"""Returns-logistics analytics expressed as Spark DataFrame plans."""

from retrolane.clock import Clock
from retrolane.sources.catalog import Catalog

__all__ = ["Catalog", "Clock"]

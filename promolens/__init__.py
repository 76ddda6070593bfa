"""promolens: promotion and loyalty analytics as Spark DataFrame plans."""

from promolens.config import Settings
from promolens.sources.catalog import Catalog

__all__ = ["Catalog", "Settings"]

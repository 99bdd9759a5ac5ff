"""Financial peer benchmarking as PySpark DataFrame operators."""

from sectorgauge.config import Settings

__all__ = ["Settings"]

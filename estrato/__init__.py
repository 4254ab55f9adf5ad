"""estrato: layered (bronze, silver, gold, quality) indicator analytics on Spark."""

from estrato.config import LakeConfig, SourceSpec

__all__ = ["LakeConfig", "SourceSpec"]

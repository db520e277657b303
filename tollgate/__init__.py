"""Transaction-risk analytics as Spark DataFrame jobs."""

from tollgate.config import Config

__all__ = ["Config"]

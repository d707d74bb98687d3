"""Urban traffic and air-quality analytics as Spark DataFrame operators."""

from smogway.settings import Settings

__all__ = ["Settings"]

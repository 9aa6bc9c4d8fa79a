"""Analytics for gaming-venue operations, written as Spark DataFrame plans."""

from floorlens.sources.bind import Floor, bind

__all__ = ["Floor", "bind"]

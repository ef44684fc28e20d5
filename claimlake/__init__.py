"""Claims risk analytics as Spark DataFrame transformations."""

from claimlake.params import Params

__all__ = ["Params"]

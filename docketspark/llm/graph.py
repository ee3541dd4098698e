"""Connected components, as the library has them."""

from docketspark.operators.graph import components

__all__ = ["components"]

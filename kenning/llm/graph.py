"""Connected components, as the rest of the library has them."""

from kenning.operators.graph import connected_components

__all__ = ["connected_components"]

"""The package is sent along with a session by the sources' helper."""

from ledgerlens.sources.shipping import ship

__all__ = ["ship"]

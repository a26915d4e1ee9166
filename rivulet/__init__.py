"""Water and climate analytics on Spark."""

from rivulet.session import build_session

__all__ = ["build_session"]

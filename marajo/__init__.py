"""PySpark-native toolkit for public-sector data and corpus preparation."""

from marajo.session import build_session, checkpoint_root, stash

__all__ = ["build_session", "checkpoint_root", "stash"]

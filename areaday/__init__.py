"""areaday: daily, per-area event risk as Spark DataFrame plans."""

from areaday.session import build_session

__all__ = ["build_session"]

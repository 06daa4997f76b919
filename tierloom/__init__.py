"""Tierloom: nested documents to ranked analytics tables, as Spark jobs."""

from tierloom.naming import Naming
from tierloom.session import build_session

__all__ = ["Naming", "build_session"]

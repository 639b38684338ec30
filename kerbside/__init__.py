"""Shared-vehicle fleet reporting on Spark DataFrames."""

from kerbside.period import ReportPeriod
from kerbside.session import build_session, configure

__all__ = ["ReportPeriod", "build_session", "configure"]

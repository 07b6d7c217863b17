"""Retail warehouse jobs on PySpark: raw files to staging, silver, gold and reports."""

from shelfmark.clock import RunClock

__all__ = ["RunClock"]

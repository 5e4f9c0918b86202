"""Shared column expressions."""

from tapflow.functions.columns import epoch_seconds, flag, line_number

__all__ = ["epoch_seconds", "flag", "line_number"]

"""Structured Streaming helpers (fitted transforms on file streams)."""

from tabforge.streaming.fitted_transform import run_available

__all__ = ["run_available"]

"""Structured Streaming intake of daily file drops."""

from dayfold.streaming.intake import start_intake  # noqa: F401

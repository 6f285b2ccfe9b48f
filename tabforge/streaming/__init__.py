"""Stateless scoring of streaming DataFrames."""

from tabforge.streaming.scoring import score_stream, start_scoring

__all__ = ["score_stream", "start_scoring"]

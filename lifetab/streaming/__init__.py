"""Streaming form of scoring a stored model (I9) with Structured Streaming."""

from .scoring import score_stream, start_scoring

__all__ = ["score_stream", "start_scoring"]

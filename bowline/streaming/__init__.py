"""Structured Streaming entry points."""

from bowline.streaming.scoring import score_stream

__all__ = ["score_stream"]

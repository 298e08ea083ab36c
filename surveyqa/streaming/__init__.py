"""Checks on streams."""

from surveyqa.streaming.cross_check import stream_mismatch
from surveyqa.streaming.validate import resent_once, validate_stream

__all__ = ["resent_once", "stream_mismatch", "validate_stream"]

"""Detections whose windows close with time, as Structured Streaming queries."""

"""Detections, feature builds, hunts, scoring and pack runs."""

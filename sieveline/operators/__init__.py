"""Table-agnostic DataFrame operators the detections are composed of."""

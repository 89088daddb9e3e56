"""Table schemas, discovery, cleaning and artifact sinks."""

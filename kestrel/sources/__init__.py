"""kestrel.sources."""

"""kestrel.functions."""

"""tripflow.sources."""

"""tripflow.streaming."""

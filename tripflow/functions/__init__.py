"""tripflow.functions."""

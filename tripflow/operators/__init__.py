"""tripflow.operators."""

"""tripflow.plans."""

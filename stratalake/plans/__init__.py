"""Table builders and pipelines made of the operators."""

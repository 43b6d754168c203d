"""corpusloom operators."""

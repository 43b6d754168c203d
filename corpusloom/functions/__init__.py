"""corpusloom functions."""

"""corpusloom plans."""

"""corpusloom streaming."""

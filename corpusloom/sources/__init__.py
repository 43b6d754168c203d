"""corpusloom sources."""

"""corpusloom: a Spark-first engine for retrieval corpora and their evaluation."""

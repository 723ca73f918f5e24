"""gleanery: Spark-native resolution of overlapping listings, plus corpus operators in ``gleanery.llm``."""

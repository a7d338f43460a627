"""Spark-first curation, repair, structuring and description of document collections."""

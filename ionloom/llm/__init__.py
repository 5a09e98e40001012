"""Operators of a training-data pipeline, each a set of Spark jobs over documents, pages or vectors."""

"""Corpus curation and mixture planning as Spark DataFrame transformations."""

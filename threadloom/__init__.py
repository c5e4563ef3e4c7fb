"""Corpus curation and entity resolution on Spark DataFrames."""

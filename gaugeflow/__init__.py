"""Labelled endpoint records on Spark: read, decode, archive, train and score."""

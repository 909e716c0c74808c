"""Labelled file collections, embeddings and classifier evaluation as Spark DataFrames."""

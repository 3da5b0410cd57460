"""Labelled-identity datasets on Spark: candidates, admission, splits, summaries."""

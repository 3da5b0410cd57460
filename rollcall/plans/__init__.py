"""Jobs from files to the labelled dataset; each takes and gives DataFrames, ``run`` strings them together."""

from .jobs import Settings, build_dataset, extract, generate, preprocess, run

__all__ = ["Settings", "build_dataset", "extract", "generate", "preprocess", "run"]

"""Relational steps: sampling, planning, scoring, admission, joins with guards, splits, chunks, summaries."""

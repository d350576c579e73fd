"""Relational operators: passages, ranking, sampling, judging, mining."""

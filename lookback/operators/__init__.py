"""Operators: code matching and unnest, claims rule, coverage, first event, statistics."""

"""Whole jobs over a lake folder: medallion, training, scoring, monitoring."""

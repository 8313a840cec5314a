"""Typed scans, partitioned snapshot stores, scratch tables and the model registry."""

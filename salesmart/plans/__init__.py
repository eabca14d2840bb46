"""Sinks and the end-to-end pipeline."""

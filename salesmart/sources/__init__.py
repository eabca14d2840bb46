"""Readers of the raw inputs."""

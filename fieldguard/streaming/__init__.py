"""Staged streams."""

"""Cleaning new raw files as they arrive."""

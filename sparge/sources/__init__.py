"""Readers: raw files, lake tables, file manifests, change streams."""

"""Forensic and dashboard queries over the lake tables."""

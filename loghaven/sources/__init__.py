"""Readers for raw logs and network-connection records."""

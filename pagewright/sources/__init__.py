"""Readers of page collections."""

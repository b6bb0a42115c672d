"""Landed JSON responses and stored tables."""

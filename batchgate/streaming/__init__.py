"""Sheets as they arrive."""

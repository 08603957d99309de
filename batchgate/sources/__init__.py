"""Sheets, reference tables and accumulators."""

"""Expressions over record texts, times and numbers."""

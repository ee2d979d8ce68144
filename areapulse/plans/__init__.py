"""Composed queries: declarative summaries, analysis tools and payloads."""

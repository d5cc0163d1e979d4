"""Readers: hourly feed files, the keyed log, landed and curated tables."""

"""Retail feeds on Spark: decode, clean, anonymise, land and curate them."""

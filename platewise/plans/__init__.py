"""Cleaning, star schema, reports, catalogue and data-quality jobs."""

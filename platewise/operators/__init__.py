"""Relational building blocks: de-duplication, look-ups, imputation, quantiles, reshaping, audit."""

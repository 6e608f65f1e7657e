"""Catalogue data quality on Spark: cleaning, validation, brand unification, label checks."""

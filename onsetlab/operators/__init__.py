"""Cohort, feature, split and model operators."""

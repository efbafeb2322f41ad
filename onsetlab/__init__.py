"""Mortality-risk training data and scores from OMOP patient tables, on Spark.

Every public function takes and returns DataFrames; nothing here holds a
session of its own.
"""

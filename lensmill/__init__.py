"""Clinic reporting on Spark: scorecards, capacity, mail audiences and claim files as DataFrames."""

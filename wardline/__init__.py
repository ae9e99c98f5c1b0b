"""Clinic-operations data pipeline and reporting library on Spark DataFrames."""

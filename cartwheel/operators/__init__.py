"""Operators: functions from DataFrames to a DataFrame, built-in Spark
expressions only, no actions - except the noted pre-passes of the median and
the histogram, which fetch bounded scalars / rows, and their reliable
checkpoint of the per-user spend table."""

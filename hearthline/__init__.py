"""Lending analytics on Spark: landing, modelling, conforming and reporting.

Every operator takes DataFrames and returns DataFrames; nothing here runs a
job unless its docstring says so.
"""

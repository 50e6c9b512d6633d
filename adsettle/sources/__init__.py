"""Workbooks, landed tables and file listings as DataFrames."""

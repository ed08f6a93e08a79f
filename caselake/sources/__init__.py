"""Inputs: CSV files under any Hadoop URI, catalog tables, SQL projections."""

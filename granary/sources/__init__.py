"""Inputs and outputs: CSV files, tables and their layouts, the 13 source specs."""

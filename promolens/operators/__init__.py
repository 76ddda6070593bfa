"""Stages of the analysis. Each takes DataFrames and returns one, starting no job unless it says so."""

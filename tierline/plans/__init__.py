"""Compositions a user calls: the layered pipeline, its gates, the analysis reports."""

"""Whole plans: the load, the reports, the scores."""

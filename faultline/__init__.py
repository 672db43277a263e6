"""Incident-record analytics on Spark: sources, cleaning, quality, scoring, reports."""

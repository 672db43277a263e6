"""Sinks: snapshots, facts, dimensions, results and reports."""

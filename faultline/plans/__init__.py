"""Plans: the analytic questions and the jobs that chain operators."""

"""Flows built from the operators: live, retired rules, retired cleaning, the daily job."""

"""Whole plans: versioned tables, the query catalogue, registered queries."""

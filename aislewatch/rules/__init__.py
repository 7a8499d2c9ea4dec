"""Retailer policies as plain rows: phrases, patterns, thresholds and precedence."""

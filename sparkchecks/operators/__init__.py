"""Checks: of columns, of totals, of grouped sums and shares, and of coverage."""

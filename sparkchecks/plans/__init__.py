"""Rule sets, runs and reports."""

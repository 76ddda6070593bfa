"""Data checks: one aggregation per dataset, results as rows."""

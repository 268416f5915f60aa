"""Column functions: ordering, keyword categories, masks and KPI formatting."""

"""lakeops."""

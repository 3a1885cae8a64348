"""Queries over the driver's tables, each with the SQL that states its expected result."""

"""Whole commands, and the queries of the driver contract."""

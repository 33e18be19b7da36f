"""Retally: reporting tables over change data, kept exact under inserts, updates and deletes."""

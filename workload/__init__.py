"""The library on the given tables: derived source tables, queries and their SQL counterparts."""

"""Registered queries, their SQL counterparts and the tables they share."""

"""Operators over visits: filters, scopes, splits, aggregates, dimensions, refresh."""

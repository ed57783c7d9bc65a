"""Backfills over a range of months, and the registered queries."""

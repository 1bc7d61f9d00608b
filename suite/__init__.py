"""Registered queries: inputs derived from the driver tables, with SQL to check them against."""

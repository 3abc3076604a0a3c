"""Operators composed into jobs and named queries."""

"""Readers for landed files, tables and streams."""

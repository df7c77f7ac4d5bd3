"""Typed readers for landed tables, station files and JSON payloads."""

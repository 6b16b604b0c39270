"""Scans, declared schemas and sinks."""

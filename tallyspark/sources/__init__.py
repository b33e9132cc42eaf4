"""Scans and sinks: the driver's tables, derived stand-in views, and file I/O jobs."""

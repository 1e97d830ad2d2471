"""Scans, time filters, reference dimensions and the benchmark table views."""

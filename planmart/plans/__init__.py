"""Composite plans: reports, serving reads, dashboard panels, the daily
pipeline and the registry of named queries."""

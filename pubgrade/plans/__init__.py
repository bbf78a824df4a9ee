"""Whole jobs: indicator reports, correction chains and run monitoring."""

"""Operators for preparing training text: scoring, scans, deduplication, decontamination, mixing."""

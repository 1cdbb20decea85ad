"""Operators for preparing training text: filtering, near-duplicates,
scans, packing and formatting, each as a Spark job over whole tables."""

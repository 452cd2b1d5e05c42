"""Workforce-effort analytics on Spark: refine raw task/leave/member data, keep
refined tables current, and publish logged-vs-expected hours per member-month."""

__version__ = "0.1.0"

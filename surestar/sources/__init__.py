"""Feeds, the warehouse folder and the audit trail."""

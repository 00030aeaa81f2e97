"""Relational operators over retail tables, manifests and action logs."""

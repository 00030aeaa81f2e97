"""Whole-batch plans: the violation report, and building, publishing and serving generations."""

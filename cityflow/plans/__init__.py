"""Whole plans: feature tables, the warehouse, the analytical views and the lake queries."""

"""Queries over the star schema: views, business questions, reports."""

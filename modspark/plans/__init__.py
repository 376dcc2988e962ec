"""Composite plans: one object in, one nested result or record out."""

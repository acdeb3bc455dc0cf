"""Composite plans: fetch, prebatch, batch."""

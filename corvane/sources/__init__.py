"""Readers of journals, payloads, pages and records."""

"""Streams of change events and of list coverage."""

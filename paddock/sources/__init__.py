"""Readers and writers."""

"""Readers (S)."""

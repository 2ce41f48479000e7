"""Readers for labelled text, JSON lines and stop words."""

"""Landed files in, tables out."""

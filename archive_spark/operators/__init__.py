"""Operators on pages, links, segments and stored files."""

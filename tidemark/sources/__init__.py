"""Readers: landed files, tables, markup and nested text."""

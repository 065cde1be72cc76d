"""Readers: catalog arrays, index pages, blob tables, ZIP archives and register XML."""

"""Readers: files, tables, captured JSON pages, HTML tables, run manifests."""

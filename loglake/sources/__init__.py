"""Readers. Each returns a lazy DataFrame whose filters and columns reach the scan."""

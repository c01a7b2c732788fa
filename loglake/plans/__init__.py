"""Batch loads: from records or archive files into the lake."""

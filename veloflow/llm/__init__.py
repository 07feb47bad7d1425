"""Operators for preparing text corpora: search, secrets, token files, mixing, quality, WARC, chat, near-duplicates, HTML, packing."""

"""Structured Streaming forms of the crawl and index loops."""

"""Readers for files, requests and archives; sinks for results and errors."""

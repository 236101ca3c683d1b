"""Readers: files and message columns in, typed frames out."""

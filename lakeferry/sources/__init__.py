"""Readers: relational databases, export files, landed responses, artifacts."""

"""Readers and writers for survey files."""

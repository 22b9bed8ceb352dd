"""Readers and writers of survey files."""

"""Readers, extraction jobs and writers."""

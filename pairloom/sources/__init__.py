"""Readers and writers of the formats that records come in."""

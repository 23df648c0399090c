"""Readers and writers; every location, format and credential is a parameter."""

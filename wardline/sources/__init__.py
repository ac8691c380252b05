"""Readers, writers and the declared table layouts."""

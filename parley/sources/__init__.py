"""Readers, writers and corpus stand-ins."""

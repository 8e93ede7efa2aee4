"""Readers, writers and the places they read from and write to."""

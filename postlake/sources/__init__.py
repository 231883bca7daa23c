"""Readers for the symbol master, the dictionary and captured responses."""

"""Whole jobs, from captured responses to stored rows."""

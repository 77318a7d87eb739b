"""Registered queries, their oracle SQL, and composed plans."""

"""Reusable DataFrame operators: intervals, drug supply, value sets, episodes."""

"""Continuous form of landing and latest-wins."""

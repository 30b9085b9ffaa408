"""Whole flows, and the shapes of the test tables."""

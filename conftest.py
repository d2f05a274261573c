"""Puts the repository root on the path for tests."""

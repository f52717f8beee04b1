"""Checks as DataFrame operators."""

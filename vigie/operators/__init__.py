"""Vigie subpackage."""

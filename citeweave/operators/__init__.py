"""Operators over ordered lines, groups and nested records."""

"""Operators for preparing training text, one module each; nothing outside this subpackage imports it."""

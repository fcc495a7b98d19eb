"""Operators for large text collections; nothing outside this subpackage imports it."""

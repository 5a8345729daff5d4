"""Operators over text corpora: one module per operator, and the registry of their queries."""

"""User-level DataFrame operators."""

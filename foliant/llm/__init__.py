"""Operators for preparing training text. Nothing else in foliant imports this subpackage."""

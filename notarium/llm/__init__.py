"""Operators for preparing text collections. Nothing else in the package imports this subpackage."""

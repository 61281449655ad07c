"""Operators for building text training sets. Nothing else in the package imports this one."""

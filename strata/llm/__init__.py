"""Operators of a training-data pipeline (nothing else in the library imports
this subpackage; it may be deleted as a whole)."""

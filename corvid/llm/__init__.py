"""Operators of a training-data pipeline. Nothing else in the library imports
this subpackage; ``queries`` registers one query per operator."""

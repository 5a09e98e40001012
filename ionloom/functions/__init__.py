"""Subpackage of ionloom."""

"""Relational operators of the snapshot build, as DataFrame functions."""

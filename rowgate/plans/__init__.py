"""Declared table contracts and the run from raw tables to a published fact."""

"""Readers of the nine raw tables and writers of the built ones."""

"""Registered queries with their reference SQL."""

"""Reusable DataFrame operators of the warehouse build."""

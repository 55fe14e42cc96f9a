"""Hierarchical panel analytics as Spark plans."""

"""Queues worked off as streams."""

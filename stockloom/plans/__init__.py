"""Whole runs composed from the operators, and the registered queries."""

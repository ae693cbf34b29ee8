"""Whole flows: the player snapshot questions and models, and the registered queries."""

"""Relational operators: planning, links, state, tallies, word repair, geometry."""

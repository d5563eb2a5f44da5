"""Composite builders: the star model (C1-C7), marts (C8-C11), quality gate (C12), jobs."""

"""Queries of the driver contract: each operator of the package over the given tables."""

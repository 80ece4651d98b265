"""Registered queries by family, each with the oracle's SQL of the same meaning or None."""

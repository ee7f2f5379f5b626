"""Governed stages: operators assembled into certified runs."""

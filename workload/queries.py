"""Importing this module registers every query."""

from workload import flows, records, shapes, texts  # noqa: F401

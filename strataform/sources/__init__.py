"""Readers, writers and the driver-table adapter."""

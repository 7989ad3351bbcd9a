"""Readers and writers for the named tables that the analysis stages exchange."""

"""Sinks: loads into catalog tables."""

"""Payload codec, hashes and error classes."""

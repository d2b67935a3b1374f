"""Readers: message topics, document collections, endpoint configuration."""

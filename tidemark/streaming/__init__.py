"""Structured Streaming drivers: journal, apply and bootstrap."""

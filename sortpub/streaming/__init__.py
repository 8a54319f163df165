"""Bounded consumption with Structured Streaming."""

"""Structured Streaming jobs over event and request streams."""

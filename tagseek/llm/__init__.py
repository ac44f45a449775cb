"""Preparing training data at scale; nothing else in the library needs this."""

"""Structured Streaming forms of the operators; each gives what its batch form gives."""

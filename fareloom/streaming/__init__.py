"""Structured Streaming forms of the jobs; each gives what its batch form gives."""

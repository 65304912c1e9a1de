"""Whole runs: scoring pipeline, digest, audited automation run."""

"""Chunk, fingerprint, pseudonymise and incrementally sync text corpora on Spark."""

"""Readers: driver tables, stand-in roles, stream sources, start positions, chunked snapshots."""

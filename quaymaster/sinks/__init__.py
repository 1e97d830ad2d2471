"""Writes: the archive, the serving table and versions of the state."""

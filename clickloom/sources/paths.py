"""Paths, directories and scratch tables, under the name readers and sinks use."""

from ..paths import Directory, join, pinned, recover, scratch_dir, staging

__all__ = ["Directory", "join", "pinned", "recover", "scratch_dir", "staging"]

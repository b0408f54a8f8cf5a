"""Change-stream building blocks; see the README."""

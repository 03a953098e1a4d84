"""Part of quern; see README.md."""

"""Landing files as streams."""

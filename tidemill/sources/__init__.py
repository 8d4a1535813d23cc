"""Landing files, dead letters and table readers/writers."""

"""Work planning and whole runs."""

"""Where visits come from, and where tables go."""

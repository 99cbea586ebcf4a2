"""Where results go."""

"""Where readings and stored tables come from."""

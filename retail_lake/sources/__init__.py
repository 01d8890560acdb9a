"""Where raw data comes from."""

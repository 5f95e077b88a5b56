"""Where messages come from and where results go."""

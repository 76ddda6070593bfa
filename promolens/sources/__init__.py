"""Where the tables come from and where results go."""

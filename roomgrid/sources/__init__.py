"""Where the twelve tables come from and where they go."""

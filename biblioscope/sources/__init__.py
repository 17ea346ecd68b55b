"""Where reports read from and where they keep intermediate tables."""

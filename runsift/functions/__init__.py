"""Column functions without any joins or shuffles."""

"""The three chains of operators a user runs end to end."""

"""Model plans: staging (M1–M3), intermediate (M4–M8), marts."""

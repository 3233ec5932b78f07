"""Column functions and small reusable plan fragments."""

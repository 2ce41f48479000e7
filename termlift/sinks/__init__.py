"""Text and model writers."""

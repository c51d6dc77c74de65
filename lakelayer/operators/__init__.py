"""lakelayer package."""

"""Where collections live."""

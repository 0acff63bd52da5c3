"""Training-data operators (quality, dedup, mixing, tokenizing, scanning). Nothing else in the library imports this package."""

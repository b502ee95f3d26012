"""Operators that prepare documents for training: language, duplicates, quality, token counts, mixing, packing."""

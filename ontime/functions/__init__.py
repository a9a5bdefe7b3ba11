"""Column builders and packed-field decoding."""

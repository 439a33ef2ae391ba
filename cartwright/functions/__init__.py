"""Column-level building blocks: code decoding, text, id lists, money, time."""

"""Column functions: cleaning, literals, wire frames, identity, text and vectors."""

"""Domain plans: behaviour, scoring, labels, features, quality and parity."""

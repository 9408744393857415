"""Operators for building language-model training data at scale, one module each; nothing else imports them."""

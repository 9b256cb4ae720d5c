"""Operators for building training data out of web documents. Nothing else imports this package."""

"""Operators for text that is prepared for training language models. Nothing else imports this package."""

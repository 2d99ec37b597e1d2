"""Operators for training-data pipelines over text corpora; nothing else imports them."""

"""Operators for preparing text and entity data for training corpora; nothing else in the package imports this."""

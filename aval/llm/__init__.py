"""Operators for preparing text for language models; nothing else in the package imports them."""

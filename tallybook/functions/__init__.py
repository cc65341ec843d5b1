"""Parsers as column expressions: text, money, dates."""

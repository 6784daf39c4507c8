"""Operators of a training-data pipeline and their queries; nothing outside imports this package."""

"""Operators that turn raw documents into training data. Nothing outside this package imports it."""

"""Relational operators that go beyond one DataFrame call."""

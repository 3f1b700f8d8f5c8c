"""Readers. All of them are lazy and take explicit schemas."""

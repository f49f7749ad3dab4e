"""Readers: market, user, request, prediction and snapshot tables."""

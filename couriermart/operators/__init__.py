"""Reusable jobs over any DataFrame that follows the message contract."""

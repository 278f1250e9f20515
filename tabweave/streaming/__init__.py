"""Fitted transforms applied to streaming frames."""

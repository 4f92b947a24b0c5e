"""Checks of the library over the driver's retail tables."""

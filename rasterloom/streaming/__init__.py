"""Restartable streaming form of the image job."""

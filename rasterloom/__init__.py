"""Product-image dataset preparation as Spark DataFrame jobs."""

from rasterloom.session import session, shared_dir, ship

__all__ = ["session", "shared_dir", "ship"]

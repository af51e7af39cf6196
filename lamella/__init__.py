"""Lamella: the data side of a large image-embedding programme as Spark jobs."""

from lamella.session import build_session, scratch_dir, ship_package, stable

__all__ = ["build_session", "scratch_dir", "ship_package", "stable"]

ship_package()

"""Reading and writing symbol bundles."""

from symcube.sources.bundle import Bundle
from symcube.sources.writer import BundleWriter

__all__ = ["Bundle", "BundleWriter"]

"""tracksync: a registry -> tracker synchroniser and exporter on Spark DataFrames."""

from .config import SyncConfig

__all__ = ["SyncConfig"]
__version__ = "0.1.0"

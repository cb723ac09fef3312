"""Structured Streaming entry points."""
from .bronze_stream import start_bronze_stream, vault_refresher
from .progress import ProgressRecorder

__all__ = ["ProgressRecorder", "start_bronze_stream", "vault_refresher"]

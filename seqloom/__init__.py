"""DataFrame operators and streams for protein-annotation data on Spark."""

from seqloom.session import configure, local_session

__all__ = ["configure", "local_session"]

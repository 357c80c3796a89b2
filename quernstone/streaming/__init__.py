"""An extension: the incremental update fed by a stream of page snapshots."""

from .updates import start_updates

__all__ = ["start_updates"]

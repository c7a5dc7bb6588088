"""Tables that cut lineage, in the folder all executors share."""

from strataflow.operators.scratch import discard, settle, shared_dir, stored

__all__ = ["discard", "settle", "shared_dir", "stored"]

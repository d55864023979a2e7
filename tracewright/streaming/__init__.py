"""Streaming forms of batch operators: an extension, not part of the batch inventory."""

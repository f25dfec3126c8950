"""Structured Streaming jobs. All run to the end of the input and stop (``availableNow``) unless given a trigger.

Checkpoint folders are the caller's and belong on shared storage; every sink is
idempotent per batch, so a restarted query neither loses nor repeats rows.
"""

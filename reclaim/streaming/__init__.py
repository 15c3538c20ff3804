"""Incremental runs of existing operators with Structured Streaming.

The original tool has no streams.  This package adds no operator: it keeps
the per-brand totals behind the payment and fulfillment alerts (H5, H6) as
streaming state over event files that keep arriving, and applies the same
alert rules to the running totals after every micro-batch.
"""

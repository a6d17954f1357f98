"""Tables that change from run to run.

The data model has no event streams.  What it has is state carried between
batch runs: an append-only audit and type-2 histories.  They live here.
"""
